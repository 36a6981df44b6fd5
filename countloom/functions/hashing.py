"""Seeded polynomial hashing, written once and rendered for Spark, DuckDB and Python.

A hash is a polynomial over the integers modulo a prime.  Every Horner step stays below
``prime ** 2 < 2 ** 62``, so BIGINT arithmetic never overflows under ANSI mode.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

# The two prime moduli on offer.
MERSENNE_31 = 2_147_483_647
SMALL_PRIME = 8191


@dataclass(frozen=True)
class PolyHash:
    """``x -> c0 * x^n + ... + cn (mod prime)``, coefficients from the highest power down."""

    prime: int
    coefs: tuple[int, ...]

    @classmethod
    def draw(cls, rng: random.Random, degree: int, prime: int = MERSENNE_31) -> PolyHash:
        lead = rng.randrange(1, prime)
        return cls(prime, (lead, *(rng.randrange(prime) for _ in range(degree))))

    def _horner(self, residue: str) -> str:
        text = f"{self.coefs[0]}"
        for coef in self.coefs[1:]:
            text = f"(({text}) * {residue} + {coef}) % {self.prime}"
        return f"({text})"

    def spark(self, x: str) -> str:
        """Spark SQL text; ``x`` is any BIGINT expression, negative values included."""
        return self._horner(f"pmod({x}, {self.prime}L)")

    def duckdb(self, x: str) -> str:
        return self._horner(f"((({x}) % {self.prime} + {self.prime}) % {self.prime})")

    def spark_row(self, terms: int) -> str:
        """Prime and coefficients as an array, for ``indexed_hash``; missing high terms are zero."""
        return f"array({', '.join(f'{n}L' for n in (self.prime, *(0,) * (terms - len(self.coefs)), *self.coefs))})"

    def value(self, x: int) -> int:
        acc = self.coefs[0]
        for coef in self.coefs[1:]:
            acc = (acc * (x % self.prime) + coef) % self.prime
        return acc


def indexed_hash(x: str, row: str, terms: int) -> str:
    """The hash of ``x`` by the coefficients in the array ``row``, as ``PolyHash.spark_row`` lays them out."""
    text = f"{row}[1]"
    for at in range(2, terms + 1):
        text = f"(({text}) * pmod({x}, {row}[0]) + {row}[{at}]) % {row}[0]"
    return f"({text})"


@dataclass(frozen=True)
class Colouring:
    """A hash of vertices onto ``0 .. colours - 1``."""

    colours: int
    hash: PolyHash

    @classmethod
    def seeded(cls, colours: int, seed: int, family: str = "poly") -> Colouring:
        """``poly`` is 3-wise independent, as the triangle estimate needs; ``linear8191`` is a
        linear hash modulo 8191, kept for parity with colourings made that way."""
        if colours < 1:
            raise ValueError("colours must be at least 1")
        rng = random.Random(seed)
        if family == "poly":
            return cls(colours, PolyHash.draw(rng, degree=2))
        if family == "linear8191":
            return cls(colours, PolyHash.draw(rng, degree=1, prime=SMALL_PRIME))
        raise ValueError(f"unknown hash family: {family}")

    def spark(self, x: str) -> str:
        return f"({self.hash.spark(x)} % {self.colours})"

    def duckdb(self, x: str) -> str:
        return f"({self.hash.duckdb(x)} % {self.colours})"

    def value(self, x: int) -> int:
        return self.hash.value(x) % self.colours


@dataclass(frozen=True)
class EdgePartitioning:
    """A hash of canonical edges onto ``0 .. partitions - 1``."""

    partitions: int
    mix: tuple[int, int]
    hash: PolyHash

    @classmethod
    def seeded(cls, partitions: int, seed: int) -> EdgePartitioning:
        if partitions < 1:
            raise ValueError("partitions must be at least 1")
        rng = random.Random(seed)
        mix = (rng.randrange(1, MERSENNE_31), rng.randrange(1, MERSENNE_31))
        return cls(partitions, mix, PolyHash.draw(rng, degree=2))

    def spark(self, u: str, v: str) -> str:
        a, b = self.mix
        p = self.hash.prime
        return f"({self.hash.spark(f'({a} * pmod({u}, {p}L) % {p} + {b} * pmod({v}, {p}L) % {p})')} % {self.partitions})"

    def duckdb(self, u: str, v: str) -> str:
        a, b = self.mix
        p = self.hash.prime
        ru, rv = (f"((({x}) % {p} + {p}) % {p})" for x in (u, v))
        return f"({self.hash.duckdb(f'({a} * {ru} % {p} + {b} * {rv} % {p})')} % {self.partitions})"


@dataclass(frozen=True)
class SketchRow:
    """One row of a Count Sketch: a bucket hash and an independent sign hash, both 4-wise."""

    width: int
    bucket_hash: PolyHash
    sign_hash: PolyHash

    @classmethod
    def draw(cls, rng: random.Random, width: int) -> SketchRow:
        return cls(width, PolyHash.draw(rng, degree=3), PolyHash.draw(rng, degree=3))

    def bucket(self, x: str, engine: str = "spark") -> str:
        return f"({getattr(self.bucket_hash, engine)(x)} % {self.width})"

    def sign(self, x: str, engine: str = "spark") -> str:
        return f"(1 - 2 * ({getattr(self.sign_hash, engine)(x)} % 2))"
