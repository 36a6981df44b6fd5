"""Edge lists and item streams, from text, tables or a streaming source."""
