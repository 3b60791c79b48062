"""Sharding with a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a table of prime
size: start at an offset and step by a skip, both from the shard's name; a
prime size makes each order visit every slot.  The shards take turns, each
claiming the next free slot of its order, until the table is full, so slot
counts differ by one at most, and adding or removing a shard moves few slots.

A row is placed by one lookup: md5 of its key modulo the table size.  The table
has ``table_size`` rows whatever the data holds, so it is always broadcast.

Defined cases: the key of a row with a null id is its text (null: empty);
repeated ids share a shard; a very long text is hashed whole if it is the key;
an existing column named like an output column is replaced; other columns,
whatever their names, stay; an empty table stays empty.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import text_of

TABLE_SIZE = 65_537
#: Hex digits of md5 that make a slot: 60 bits.
_DIGITS = 15


def _name_hash(name: str, salt: str) -> int:
    return int.from_bytes(hashlib.md5(f"{salt}:{name}".encode()).digest()[:8], "big")


def lookup_table(shards: list[str], table_size: int = TABLE_SIZE) -> list[int]:
    """Index of the owning shard per slot.  ``table_size`` must be prime and
    at least the number of shards; shard names must differ."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be one or more different names")
    if table_size < len(shards) or any(table_size % d == 0 for d in range(2, int(table_size ** 0.5) + 1)):
        raise ValueError("table_size must be a prime of at least the number of shards")
    at = [_name_hash(s, "offset") % table_size for s in shards]
    skip = [_name_hash(s, "skip") % max(1, table_size - 1) + 1 for s in shards]
    owner, free = [-1] * table_size, table_size
    while free:
        for i in range(len(shards)):
            while owner[at[i]] >= 0:
                at[i] = (at[i] + skip[i]) % table_size
            owner[at[i]] = i
            free -= 1
            if not free:
                break
    return owner


def slot(key: Column, table_size: int = TABLE_SIZE) -> Column:
    return F.conv(F.substring(F.md5(key), 1, _DIGITS), 16, 10).cast("long") % table_size


def assign_shards(docs: DataFrame, shards: list[str], table_size: int = TABLE_SIZE, id_col: str = "doc_id",
                  text_col: str = "text", out_col: str = "shard", slot_col: str | None = None) -> DataFrame:
    """``docs`` plus the shard of each row (and its slot if named)."""
    owner = lookup_table(shards, table_size)
    table = docs.sparkSession.createDataFrame([(i, shards[s]) for i, s in enumerate(owner)],
                                              "__slot bigint, __shard string")
    key = F.coalesce(F.col(id_col).cast("string"), text_of(F.col(text_col))).cast("binary")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), slot(key, table_size).alias("__at"))
    out = rows.join(F.broadcast(table), F.col("__at") == F.col("__slot"))
    new = {out_col: F.col("__shard")} | ({slot_col: F.col("__at")} if slot_col else {})
    kept = [new.pop(c, F.col("__row")[c]).alias(c) for c in docs.columns]
    return out.select(*kept, *[v.alias(c) for c, v in new.items()])
