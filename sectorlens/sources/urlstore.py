"""A store of seen urls that a run reads only where a url can match.

Urls lie in generations, one a run, each dealt into ``buckets`` folders by the
url's hash. Beside a generation lies its Bloom filter, built by Spark as a
table of 64-bit words (bucket, word, bits). A probe joins the hash positions
of the asked urls with the filters' words; only (generation, bucket) folders
that can hold one of them are read then, and only to verify those urls. The
driver sees at most one row per generation and bucket.

Generations are listed in numbered manifests; the highest complete one holds,
so a run that dies while it adds changes nothing. When there are more than
``most_generations`` the smaller half is merged: a url is rewritten a few
times in all. One writer at a time (a stream's batches are).

Defined cases: null urls are never held; a store without generations holds
nothing; urls given twice in one run are held once.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import broadcast_if_small
from .tables import path_exists

_URL = "url string"


class UrlStore:
    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, bits_per_url: int = 16, hashes: int = 5,
                 most_generations: int = 8):
        self.spark, self.path = spark, path.rstrip("/")
        self.buckets, self.bits_per_url, self.hashes = buckets, bits_per_url, hashes
        self.most_generations = most_generations

    def _versions(self) -> list[int]:
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/manifest")
        files = where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(where):
            return []
        names = [s.getPath().getName() for s in files.listStatus(where)]
        numbers = [int(n[2:]) for n in names if n.startswith("v=")]
        return sorted(n for n in numbers if path_exists(self.spark, f"{self.path}/manifest/v={n}/_SUCCESS"))

    def generations(self) -> dict[str, int]:
        """The live generations and their numbers of urls."""
        versions = self._versions()
        if not versions:
            return {}
        return {r["gen"]: r["n"] for r in self.spark.read.parquet(f"{self.path}/manifest/v={versions[-1]}").collect()}

    def _list(self, generations: dict[str, int]) -> None:
        version = (self._versions() or [0])[-1] + 1
        rows = self.spark.createDataFrame(list(generations.items()), "gen string, n long").coalesce(1)
        rows.write.mode("overwrite").parquet(f"{self.path}/manifest/v={version}")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("url", F.lit("bucket")), F.lit(self.buckets)).cast("int")

    def _places(self, words: Column) -> Column:
        """The (word, bit) places of a url in a filter of so many words."""
        bits = F.transform(F.sequence(F.lit(0), F.lit(self.hashes - 1)), lambda i: F.pmod(F.xxhash64("url", i), words * 64))
        return F.array_distinct(F.transform(bits, lambda b: F.struct(
            F.floor(b / 64).cast("int").alias("word"), (b % 64).cast("int").alias("bit"))))

    def _write(self, urls: DataFrame, gen: str) -> int:
        """Store ``urls`` (distinct, not null) and their filter as a generation; it is not listed yet."""
        folder = f"{self.path}/urls/gen={gen}"
        urls.withColumn("bucket", self._bucket()).repartition("bucket").write.mode("overwrite") \
            .option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(folder)
        held = self.spark.read.schema("url string, bucket int").parquet(folder)
        sizes = held.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
        sizes = sizes.withColumn("words", F.ceil(F.col("n") * self.bits_per_url / 64).cast("int"))
        marked = held.join(F.broadcast(sizes.select("bucket", "words")), "bucket").select(     # a row per bucket
            "bucket", "words", F.inline(self._places(F.col("words"))))
        bits = F.expr("bit_or(shiftleft(1L, bit))").alias("bits")
        marked.groupBy("bucket", "words", "word").agg(bits).write.mode("overwrite").parquet(f"{self.path}/filters/gen={gen}")
        return sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def has(self, gen: str) -> bool:
        return gen in self.generations()

    def add(self, urls: DataFrame, gen: str) -> None:
        """Hold the given urls, which no other generation holds, as generation ``gen``."""
        live = self.generations()
        live[gen] = self._write(urls.select("url").where("url is not null").distinct(), gen)
        self._list(live)

    def merge(self) -> None:
        """Merge the smaller half of the generations if there are too many."""
        live = self.generations()
        if len(live) <= self.most_generations:
            return
        small = sorted(live, key=lambda g: (live[g], g))[:len(live) // 2 + 1]
        gen = f"merged-{uuid.uuid4().hex[:12]}"
        n = self._write(self._read({g: range(self.buckets) for g in small}).select("url"), gen)
        self._list({gen: n, **{g: k for g, k in live.items() if g not in small}})

    def _read(self, folders: dict) -> DataFrame:
        """The urls of some buckets of some generations; other folders are not opened."""
        paths = [f"{self.path}/urls/gen={g}/bucket={b}" for g, bs in sorted(folders.items()) for b in sorted(bs)
                 if path_exists(self.spark, f"{self.path}/urls/gen={g}/bucket={b}")]
        return self.spark.read.schema(_URL).parquet(*paths) if paths else self.spark.createDataFrame([], _URL)

    def generation(self, gen: str) -> DataFrame:
        return self._read({gen: range(self.buckets)})

    def urls(self) -> DataFrame:
        """Every stored url, each once."""
        return self._read({g: range(self.buckets) for g in self.generations()})

    def candidates(self, asked: DataFrame, leave_out: str | None = None) -> DataFrame:
        """(gen, bucket, url) of asked urls that the filter of a generation does not rule out."""
        live = [g for g, n in self.generations().items() if n and g != leave_out]
        if not live:
            return self.spark.createDataFrame([], "gen string, bucket int, url string")
        words = None
        for g in live:
            one = self.spark.read.parquet(f"{self.path}/filters/gen={g}").withColumn("gen", F.lit(g))
            words = one if words is None else words.unionByName(one)
        sizes = words.select("gen", "bucket", "words").distinct()        # a row per generation and bucket
        wanted = (asked.select("url").where("url is not null").distinct().withColumn("bucket", self._bucket())
                  .join(F.broadcast(sizes), "bucket")
                  .select("gen", "bucket", "url", self._places(F.col("words")).alias("places"))
                  .select("gen", "bucket", "url", F.size("places").alias("all"), F.inline("places")))
        return (wanted.join(words.drop("words"), ["gen", "bucket", "word"])
                .where(F.expr("(shiftright(bits, bit) & 1L) = 1"))
                .groupBy("gen", "bucket", "url", "all").agg(F.count(F.lit(1)).alias("hits"))
                .where(F.col("hits") == F.col("all")).select("gen", "bucket", "url"))

    def seen(self, asked: DataFrame, leave_out: str | None = None) -> DataFrame:
        """The asked urls that the store holds (outside generation ``leave_out``)."""
        could = self.candidates(asked, leave_out)
        folders: dict[str, set[int]] = {}
        for r in could.select("gen", "bucket").distinct().collect():     # at most generations x buckets
            folders.setdefault(r["gen"], set()).add(r["bucket"])
        if not folders:
            return self.spark.createDataFrame([], _URL)
        return self._read(folders).join(broadcast_if_small(asked.select("url")), "url", "left_semi")
