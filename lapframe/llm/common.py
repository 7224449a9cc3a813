"""Small helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapframe.session import delete_path, scratch_dir

# Bytes that separate words everywhere in this package.
BLANKS = r"\x20\x09-\x0D"
# Characters handled at once inside a task; a longer text is handled alone.
CHUNK_CHARS = 1 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` with a NULL text read as empty; other columns stay behind."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))


def id_fold(n: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``n``; NULL ids count as fold 0, which nothing learns from."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % n, F.lit(0).cast("bigint"))


def stored(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back.

    Cuts the lineage with files every executor can read, so a lost executor costs nothing.
    """
    path = scratch_dir(df.sparkSession, name)
    writer = df.write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Delete the files behind a frame from ``stored`` that no later plan reads."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        delete_path(df.sparkSession, folder)


# Rows of one or two integers that may be broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 2_000_000


def checked_broadcast(small: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``small``, marked for broadcast only if it is counted to have at most ``limit`` rows."""
    return F.broadcast(small) if small.limit(limit + 1).count() <= limit else small


def byte_pieces(data: bytes, limit: int = CHUNK_CHARS) -> Iterator[bytes]:
    """The bytes in pieces of about ``limit``, cut before a space or line feed; a longer word is not cut."""
    start = 0
    while len(data) - start > limit:
        spaces = [at for at in (data.find(b" ", start + limit), data.find(b"\n", start + limit)) if at >= 0]
        if not spaces:
            break
        yield data[start : min(spaces)]
        start = min(spaces)
    yield data[start:] if start else data


def text_chunks(
    batches: Iterator[pa.RecordBatch], limit: int = CHUNK_CHARS
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches whose ``text`` column holds about ``limit`` bytes, with the texts."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index("text"))
        if pa.types.is_large_string(column.type):
            column = column.cast(pa.string())
        sizes = pc.binary_length(column).to_numpy(zero_copy_only=False)
        start, used = 0, 0
        for i, size in enumerate(sizes):
            if used and used + size > limit:
                yield batch.slice(start, i - start), column.slice(start, i - start).to_pylist()
                start, used = i, 0
            used += size
        if start < len(sizes):
            yield batch.slice(start), column.slice(start).to_pylist()
