"""Reading the given tables and staging intermediate ones in the cluster's shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from onlineview.session import scratch_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def unused(columns: list[str], name: str) -> str:
    """``name``, with underscores added until no column has it (Spark compares names without case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Bits of ``narrowed`` for each key, 64-bit words of one of its bitmaps, and the most bitmaps (64 MB together).
KEY_BITS, MAP_WORDS, MAX_MAPS = 16, 64, 1 << 17


def narrowed(df: DataFrame, by: list[str], keys: DataFrame) -> DataFrame:
    """Rows of ``df`` whose columns ``by`` may be a row of ``keys``, for a join to decide that then shuffles only these.

    The hashes of all keys are marked in bitmaps, which are broadcast: two bytes a key. No row with a key is lost; of the
    others about one in 16 passes, and more where the bitmaps are full. (Words, as reading a bit of a binary copies all of it.)
    """
    maps = max(1, min(MAX_MAPS, -(-keys.count() * KEY_BITS // (64 * MAP_WORDS))))

    def place(columns: list[str]) -> tuple[Column, Column, Column]:
        """Number of the bitmap, word in it, bit of the word."""
        at = F.pmod(F.xxhash64(*columns), F.lit(maps * 64 * MAP_WORDS))
        word = F.shiftright(at, 6)
        return F.floor(word / MAP_WORDS), F.pmod(word, F.lit(MAP_WORDS)).cast("int"), at.bitwiseAND(63).cast("int")

    number, words = (unused(df.columns, n) for n in ("map_number", "map_words"))
    row, word, bit = place(keys.columns)
    marked = (keys.select(row.alias(number), word.alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("m"))
              .repartition(number).groupBy(number, "w").agg(F.bit_or("m").alias("m"))
              .groupBy(number).agg(F.map_from_entries(F.collect_list(F.struct("w", "m"))).alias("m"))
              .select(number, F.transform(F.sequence(F.lit(0), F.lit(MAP_WORDS - 1)),
                                          lambda w: F.coalesce(F.try_element_at("m", w), F.lit(0).cast("long"))).alias(words)))
    row, word, bit = place(by)
    return df.join(F.broadcast(marked), (row == F.col(number)) & (F.getbit(F.get(words, word), bit) == 1), "left_semi")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under ``spark.checkpoint.dir`` and read it back: lineage ends at files all executors share.

    The shuffle files of the write are removed when it is done, since nothing can need them again;
    they would else stay until the driver collects its garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
