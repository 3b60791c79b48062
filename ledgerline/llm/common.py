"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.session import scratch_path

#: ASCII white space, the separators of ``[^\x20\x09-\x0D]+`` words.
SPACE = r"[\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage and keeps an expensive frame from being computed once per
    use; the files are on storage all executors share, so a lost executor
    costs nothing but its running tasks.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(text: Column) -> Column:
    """The text, null read as empty."""
    return F.coalesce(text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only.  ``lower`` is the fast way for pure ASCII text and
    equal there; other letters must keep their case."""
    return (F.when(F.octet_length(text) == F.char_length(text), F.lower(text))
            .otherwise(F.translate(text, _UPPER, _UPPER.lower())))


def split_words(text: Column, separators: str = SPACE) -> Column:
    """Words between runs of ``separators``; empty for a null or blank text."""
    return F.array_remove(F.split(text_of(text), separators, -1), "")


def text_key(text: Column) -> Column:
    """With doc_id, names a row: repeated doc_ids with other texts stay apart
    and repeated rows fall together.  64 bits of the text's hash."""
    return F.xxhash64(text_of(text))


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text modulo ``n``; a null id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def unit_hash(*cols: Column) -> Column:
    """Uniform double in (0, 1), the same on every run: 52 bits of a hash."""
    bits = F.shiftrightunsigned(F.xxhash64(*cols), 12)
    return (bits.cast("double") + 0.5) / F.lit(float(1 << 52))


def small_side(df: DataFrame, max_bytes: int = 64 << 20) -> DataFrame:
    """Broadcast hint when the values of ``df``, a stored frame, take at most
    ``max_bytes``; without the hint Spark joins by shuffle, with the same
    result."""
    wide = [f.name for f in df.schema if f.dataType.simpleString() in ("string", "binary")]
    size = F.lit(16 * len(df.columns))
    for c in wide:
        size = size + F.coalesce(F.octet_length(c), F.lit(0))
    total = df.agg(F.sum(size.cast("long"))).first()[0] or 0
    return F.broadcast(df) if total <= max_bytes else df
