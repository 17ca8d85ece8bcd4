"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructField, StructType

from ..session import scratch_path

# --- fixed values: the word and separator classes of the contracts -------------
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD_RUN = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet (zstd: these tables are read once or twice, and disk is
    dearer than time) in the shared folder and read back: it cuts the lineage and survives the
    loss of any executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(_nullable(df.schema)).parquet(path)


def _nullable(schema: StructType) -> StructType:
    return StructType([StructField(f.name, f.dataType, True) for f in schema])


def ascii_lower(col):
    """Lower-case A-Z only, whatever the locale or script."""
    return F.translate(col, UPPER, LOWER)


def byte_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the A-Z-lower-cased text as UTF-8: the
    bytes methods treat exactly those six characters as blanks and exactly
    A-Z as upper case."""
    return text.encode().lower().split() if text else []


def maybe_broadcast(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """Broadcast ``df`` when its counted ``rows`` are within ``limit``; beyond it
    the join stays a shuffled one."""
    return F.broadcast(df) if rows <= limit else df


def free_name(df_columns, wanted: str) -> str:
    """``wanted``, or ``wanted`` with underscores until no column clashes
    (names compare case-insensitively)."""
    taken = {c.lower() for c in df_columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


class Memo:
    """A bounded table of computed values in two generations: when the newer one is
    full it becomes the older one, and what is asked for again moves back.  Frequent
    keys stay, memory is bounded, and a value never depends on the table's state."""

    def __init__(self, limit: int, longest: int):
        self.limit, self.longest = limit, longest
        self.new: dict = {}
        self.old: dict = {}

    def get(self, keys: list, make) -> list:
        """Values of ``keys`` in order; ``make(list of keys)`` computes those not kept
        (values are never None)."""
        got = list(map(self.new.get, keys))
        at = [i for i, v in enumerate(got) if v is None] if None in got else []
        if at:
            old = self.old
            miss = {keys[i] for i in at}
            found = {k: old[k] for k in miss if k in old}
            rest = [k for k in miss if k not in found]
            if rest:
                found.update(zip(rest, make(rest), strict=True))
            for i in at:
                got[i] = found[keys[i]]
            self.new.update((k, v) for k, v in found.items() if len(k) <= self.longest)
            if len(self.new) > self.limit:
                self.old, self.new = self.new, {}
        return got


def grouped(sizes: list[int], most: int):
    """(start, end) of consecutive groups whose sizes sum to about ``most``."""
    lo = total = 0
    for i, n in enumerate(sizes):
        total += n
        if total >= most:
            yield lo, i + 1
            lo, total = i + 1, 0
    if lo < len(sizes):
        yield lo, len(sizes)
