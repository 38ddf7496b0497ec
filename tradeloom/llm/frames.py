"""Small helpers for the operators' DataFrames."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def free_name(frame: DataFrame, wish: str) -> str:
    """`wish`, with underscores in front until no column of `frame` has that name."""
    taken = {c.lower() for c in frame.columns}
    while wish.lower() in taken:
        wish = f"_{wish}"
    return wish


def col(name: str) -> Column:
    """The column of exactly this name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def unit_hash(seed: int, *columns: Column) -> Column:
    """A number from 0 to below 1 that depends on the seed and the columns' text alone.

    It is made of the first 13 hexadecimal digits of an MD5, so other engines agree.
    """
    text = F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in columns])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


_shipped: set[str] = set()


def prepare(spark: SparkSession, batch: str = "16m") -> None:
    """Let a session run the operators: send the package to its Python workers, once, and
    bound what is passed to a worker at once, which arrays multiply there."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", batch)
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="tradeloom-")) / "tradeloom.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)
