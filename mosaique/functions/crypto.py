"""Keyed pseudonyms as column expressions: SHA-256, HMAC, AES-CTR of one block by its key stream.

All pseudonyms of a period share one key and a zero nonce, so its key stream is a constant: AES of a block of zeros. The
xor of two pseudonyms of one period is that of what they hide; this is how the format is defined.
"""

from __future__ import annotations

import hashlib
import hmac
import os
import threading

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mosaique.functions.storage import FileSystem
from mosaique.schemas import KEYS

ID_BYTES, TAG_BYTES, BLOCK = 12, 4, 16


def hash_id(identifier: Column) -> Column:
    """The first 12 bytes of SHA-256 of the identifier's bytes."""
    return F.unhex(F.substring(F.sha2(identifier.cast("binary"), 256), 1, 2 * ID_BYTES))


def hash_number(n: Column) -> Column:
    """hash_id of a number as 8 bytes, least first (as bulk generators have it)."""
    big = F.lpad(F.hex(n), 16, "0")
    return hash_id(F.unhex(F.concat(*(F.substring(big, 15 - 2 * i, 2) for i in range(8)))))


def hmac_tag(data: Column, key: bytes) -> Column:
    """The first 4 bytes of HMAC-SHA256; both pads are literals of the key."""
    block = (hashlib.sha256(key).digest() if len(key) > 64 else key).ljust(64, b"\0")
    inner = F.unhex(F.sha2(F.concat(F.lit(bytes(b ^ 0x36 for b in block)), data), 256))
    return F.unhex(F.substring(F.sha2(F.concat(F.lit(bytes(b ^ 0x5C for b in block)), inner), 256), 1, 2 * TAG_BYTES))


def _xor(a: Column, b: Column) -> Column:
    """Xor of two 16-byte values, 32 bits at a time."""
    part = lambda x, i: F.conv(F.substring(F.hex(x), 1 + 8 * i, 8), 16, 10).cast("bigint")
    return F.unhex(F.concat(*(F.lpad(F.hex(part(a, i).bitwiseXOR(part(b, i))), 8, "0") for i in range(4))))


def key_stream(key: bytes) -> Column:
    """AES of a block of zeros under the key."""
    return F.substring(F.aes_encrypt(F.lit(bytes(BLOCK)), F.lit(key), F.lit("ECB"), F.lit("PKCS")), 1, BLOCK)


def pseudonymise(hashed: Column, key: bytes) -> Column:
    return _xor(F.concat(hashed, hmac_tag(hashed, key)), key_stream(key))


def depseudonymise(pseudonym: Column, key: bytes) -> Column:
    """The 12-byte id; a tag that doesn't match fails the job, and so the period."""
    plain = _xor(pseudonym, key_stream(key))
    own = F.substring(plain, 1, ID_BYTES)
    tag = F.substring(plain, ID_BYTES + 1, TAG_BYTES)
    return F.when((F.length(pseudonym) == BLOCK) & (tag == hmac_tag(own, key)), own).otherwise(F.raise_error(F.lit("a pseudonym does not verify")).cast("binary"))


def pseudonym_table(ids: DataFrame, keys: dict[int, bytes], column: str = "id") -> DataFrame:
    """period, id, pseudonym for every id and period; one pass over the ids, a few literals for each period."""
    rows = [F.struct(F.lit(p).alias("period"), pseudonymise(hash_number(F.col(column)), k).alias("pseudonym")) for p, k in sorted(keys.items())]
    return ids.select(column, F.explode(F.array(*rows)).alias("x")).select("x.period", column, "x.pseudonym")


def lookup_key(keys: DataFrame, period: int) -> bytes:
    found = keys.where(F.col("period") == period).first()
    if found is None:
        raise KeyError(f"no key for period {period}")
    return bytes(found["key"])


class KeyTable:
    """Period keys: one random key for each period. With a folder, each key is a file of its own there, which outlives the driver;
    a file is made only where there is none, so two drivers can't both make a period's key."""

    def __init__(self, spark: SparkSession | None = None, folder: str | None = None):
        self._keys: dict[int, bytes] = {}
        self._files = FileSystem(spark, folder) if folder else None
        for name in self._files.names() if self._files else ():
            self._keys[int(name)] = self._files.read(name)

    def generate(self, *periods: int) -> bytes:
        if len(periods) != 1:
            raise ValueError("exactly one period is expected")
        (period,) = periods
        if not 0 <= period < 2**32:
            raise ValueError("the period is out of range")
        if period in self._keys:
            raise ValueError("the period has a key already")
        key = os.urandom(16)
        if self._files and not self._files.create(str(period), key):
            raise ValueError("the period has a key already")
        self._keys[period] = key
        return key

    def put(self, period: int, key: bytes) -> None:
        if len(key) != 16:
            raise ValueError("a key has 16 bytes")
        if self._files:
            self._files.delete(str(period))
            self._files.create(str(period), key)
        self._keys[period] = key

    def delete(self, period: int) -> None:
        if self._files:
            self._files.delete(str(period))
        self._keys.pop(period, None)

    def list(self) -> list[tuple[int, bytes]]:
        return sorted(self._keys.items())

    def get(self, period: int) -> bytes:
        return self._keys[period]

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.list(), KEYS)


class PseudonymService:
    """Pseudonyms of texts for a period, as the HTTP interface gives them, without the HTTP part."""

    def __init__(self, spark: SparkSession, keys: KeyTable):
        self.spark, self.keys, self._lock = spark, keys, threading.Lock()

    def pseudonymise(self, period: int, identifiers: list[str]) -> list[str]:
        if not isinstance(identifiers, list) or not all(isinstance(x, str) for x in identifiers):
            raise ValueError("identifiers must be a list of texts")
        with self._lock:
            key = self.keys.get(period)
        rows = self.spark.createDataFrame(list(enumerate(identifiers)), "n int, x string")
        got = rows.select("n", F.base64(pseudonymise(hash_id(F.col("x")), key)).alias("p")).orderBy("n").collect()
        return [r["p"] for r in got]


def tag_of(data: bytes, key: bytes) -> bytes:
    """hmac_tag on the driver, to check the expression."""
    return hmac.new(key, data, hashlib.sha256).digest()[:TAG_BYTES]
