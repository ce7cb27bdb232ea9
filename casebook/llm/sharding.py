"""Shard placement by a permutation-filled lookup table.

Every shard has its own preference order of the slots of a prime-sized table;
shards take turns claiming their next free slot until the table is full. A key
is placed by one hash and one look into the table, which is broadcast: its size
is the ``slots`` parameter, whatever the corpus. Adding or losing a shard moves
few other keys.

Defined cases: a null id has the hash of null, so all such rows share a slot;
repeated rows get the same shard; an empty frame stays empty; columns named
``slot`` or ``shard`` in the input are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from casebook.session import fresh_path

SLOTS = 65_537
SHARDS = tuple(f"shard-{n:03d}" for n in range(64))


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def preference(name: str, slots: int) -> tuple[int, int]:
    """First slot and step of a shard's walk over the table; both follow from its name alone."""
    digest = hashlib.sha256(name.encode()).digest()
    return int.from_bytes(digest[:8], "big") % slots, int.from_bytes(digest[8:16], "big") % (slots - 1) + 1


def fill_table(shards: Sequence[str], slots: int = SLOTS) -> list[int]:
    """For each slot the number of the shard that claimed it."""
    if not is_prime(slots):
        raise ValueError("the number of slots must be prime, or a walk would not reach every slot")
    if not shards or len(set(shards)) != len(shards) or len(shards) > slots:
        raise ValueError("shards must be given, differ, and be no more than the slots")
    walks = [preference(name, slots) for name in shards]
    at = [first for first, _ in walks]
    owner = [-1] * slots
    left = slots
    while True:
        for shard, (_, step) in enumerate(walks):
            while owner[at[shard]] >= 0:
                at[shard] = (at[shard] + step) % slots
            owner[at[shard]] = shard
            left -= 1
            if not left:
                return owner


def place(
    df: DataFrame, key: str = "doc_id", shards: Sequence[str] = SHARDS, slots: int = SLOTS, seed: int = 17
) -> DataFrame:
    """Add ``slot`` and ``shard`` to every row; the rest of the row stays."""
    owner = fill_table(shards, slots)
    lookup = df.sparkSession.createDataFrame(
        [(slot, shards[shard]) for slot, shard in enumerate(owner)], "slot long, shard string"
    )
    slot = F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(slots))
    placed = df.drop("slot", "shard").withColumn("slot", slot)
    columns = placed.columns
    return placed.join(F.broadcast(lookup), "slot").select(*columns, "shard")


def write_shards(placed: DataFrame, path: str) -> None:
    """Write one folder per shard; the rebalance splits a large shard over several files."""
    placed.hint("rebalance", "shard").write.partitionBy("shard").mode("overwrite").parquet(path)


def shard_documents(documents: DataFrame) -> DataFrame:
    """Place documents, write the shards, and read them back: doc_id, slot, shard, n_bytes."""
    spark = documents.sparkSession
    path = fresh_path(spark, "shards")
    placed = place(documents.select("doc_id", "text"))
    write_shards(placed, path)
    schema = "doc_id long, text string, slot long, shard string"
    return spark.read.schema(schema).parquet(path).select(
        "doc_id", "slot", "shard", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    )
