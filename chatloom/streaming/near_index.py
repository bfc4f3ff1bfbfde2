"""Near duplicates against a rolling memory that is kept as an index between micro-batches.

The newest rows' strings are remembered as tables in a folder: their prefix keys, bucketed by key, and their words,
bucketed by row. Beside them a file has the word frequencies that order every prefix, as a level for each of CELLS
cells that words are hashed to, so that strings are put in order row by row. A micro-batch is numbered on, its strings
are ordered by the remembered levels (a cell without a word is the rarest) and appended, and its keys are
joined with the tables. The tables are dealt already, so only the micro-batch's rows, keys and candidates are shuffled,
however much is remembered, and of the parts before only strings that a new row can reach are read. Parts that are too
old for the memory are dropped; after REBUILD parts the tables are written anew with fresh levels, as one part.

Keys carry the number of a block of as many rows as the memory has; a string meets those of its own block and the
one before, and stands once a micro-batch and block, so a key has at most so many strings on either side. A manifest
a micro-batch, renamed into place, names what is in effect; a repeated micro-batch replaces its own part.
"""

from __future__ import annotations

import hashlib
import json
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.functions.text import tokens
from chatloom.operators.dedup import prefix_keys, reachable
from chatloom.operators.ordering import numbered
from chatloom.sources.scratch import fs_path, stored

#: Parts after which the tables are written anew.
REBUILD = 50
#: Schema and bucketing column of the tables of a version.
TABLES = {
    "keys": ("h long, id long, last long, n long, at int, before int", "h"),
    "strings": ("id long, last long, block long, digest string, words array<string>", "id"),
}
#: The place of the key of a whole string, on which equal strings meet.
WHOLE = -1
#: Cells that words are hashed to for their frequencies, and steps of these to a doubling; which order it is matters for speed alone.
CELLS, STEPS = 1 << 16, 8


def _cell(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(CELLS)).cast("int")


class NearIndex:
    """The memory of one kind of string: rows are near if one of the cap rows before is similar (over num / den, strictly) or equal; strings without words equal each other only with blank_equal."""

    def __init__(self, spark: SparkSession, path: str, num: int, den: int, cap: int, blank_equal: bool = False, buckets: int | None = None) -> None:
        if 2 * num < den:
            raise ValueError("the threshold must be a half or more")
        self.spark, self.path, self.num, self.den, self.cap, self.blank_equal = spark, path, num, den, cap, blank_equal
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def _manifest(self, before: int) -> dict:
        """What is in effect after the last micro-batch with a lower number."""
        fs, folder = fs_path(self.spark, f"{self.path}/manifests")
        numbers = [int(s.getPath().getName()) for s in fs.listStatus(folder)] if fs.exists(folder) else []
        earlier = [n for n in numbers if n < before]
        if not earlier:
            return {"rows": 0, "version": None, "parts": {}, "buckets": self.buckets}
        stream = fs.open(fs_path(self.spark, f"{self.path}/manifests/{max(earlier)}")[1])
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, number: int, manifest: dict) -> None:
        fs, temporary = fs_path(self.spark, f"{self.path}/_temporary/{uuid.uuid4().hex}")
        out = fs.create(temporary, True)
        out.write(json.dumps(manifest).encode())
        out.close()
        _, end = fs_path(self.spark, f"{self.path}/manifests/{number}")
        fs.mkdirs(end.getParent())
        fs.delete(end, False)
        if not fs.rename(temporary, end):
            raise OSError(f"manifest {number} is not written")

    def _name(self, version: int, what: str) -> str:
        return f"near_{hashlib.md5(self.path.encode()).hexdigest()[:16]}_{version}_{what}"

    def _table(self, version: int, what: str, buckets: int) -> str:
        """The catalog's name of a table of a version, made known to the session where it isn't yet."""
        name, (schema, key) = self._name(version, what), TABLES[what]
        if not self.spark.catalog.tableExists(name):
            where = f"{self.path}/v{version}/{what}"
            fs, folder = fs_path(self.spark, where)
            fs.mkdirs(folder)
            self.spark.sql(f"CREATE TABLE {name} ({schema}, part LONG) USING parquet PARTITIONED BY (part) CLUSTERED BY ({key}) INTO {buckets} BUCKETS LOCATION '{where}'")
            self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        return name

    def _drop(self, version: int, part: int) -> None:
        for what in TABLES:
            name = self._name(version, what)
            if self.spark.catalog.tableExists(name):
                self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (part = {part})")
            fs, folder = fs_path(self.spark, f"{self.path}/v{version}/{what}/part={part}")
            fs.delete(folder, True)

    def _append(self, version: int, what: str, part: int, rows: DataFrame, buckets: int) -> None:
        _, key = TABLES[what]
        columns = [c.split()[0] for c in TABLES[what][0].split(", ")]
        rows.select(*columns, F.lit(part).cast("long").alias("part")).repartition(buckets, key).write.mode("append").insertInto(self._table(version, what, buckets))

    def _read(self, manifest: dict, what: str, parts: list[int]) -> DataFrame:
        return self.spark.table(self._table(manifest["version"], what, manifest["buckets"])).where(F.col("part").isin(parts))

    def _ordered(self, strings: DataFrame, version: int) -> DataFrame:
        """strings with their words in order from rare to frequent by the version's levels."""
        levels = F.lit(bytearray(self._levels(version)))
        level = lambda w: F.substr(levels, _cell(w) + 1, F.lit(1))
        placed = F.array_sort(F.transform("words", lambda w: F.struct(level(w).alias("level"), w.alias("word"))))
        return strings.withColumn("words", F.transform(placed, lambda x: x["word"]))

    def _keys(self, strings: DataFrame) -> DataFrame:
        """(h, id, last, n, at, before, block): a key for the whole string and those of its prefix."""
        own = strings.withColumn("n", F.size("words").cast("long"))
        whole = F.struct(F.xxhash64(F.lit("whole"), "digest").alias("h"), F.lit(WHOLE).alias("at"), F.lit(0).alias("before"))
        equal = own if self.blank_equal else own.where("n > 0")
        keyed = own.where("n > 0").withColumn("key", F.explode(prefix_keys(self.num, self.den))).unionByName(equal.withColumn("key", whole))
        return keyed.select("key.h", "id", "last", "n", "key.at", "key.before", "block")

    @staticmethod
    def _at_block(h: str, block: Column) -> Column:
        return F.xxhash64(h, block)

    def _write(self, version: int, part: int, strings: DataFrame, buckets: int) -> None:
        self._drop(version, part)
        self._append(version, "strings", part, strings, buckets)
        self._append(version, "keys", part, self._keys(strings).withColumn("h", self._at_block("h", F.col("block"))), buckets)

    def _levels(self, version: int) -> bytes:
        stream = fs_path(self.spark, f"{self.path}/v{version}/levels")
        opened = stream[0].open(stream[1])
        try:
            return bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(opened))
        finally:
            opened.close()

    def _words_of(self, version: int, strings: DataFrame) -> None:
        """The levels of a version, which never change: all of its prefixes are in one order."""
        counts = strings.select(F.explode("words").alias("word")).groupBy(_cell(F.col("word")).alias("cell")).agg(F.count("*").alias("df")).toPandas()
        levels = np.zeros(CELLS, dtype=np.uint8)
        levels[counts["cell"].to_numpy(dtype=np.int64)] = np.minimum(STEPS * np.log2(1 + counts["df"].to_numpy(dtype=np.float64)), 255)
        fs, where = fs_path(self.spark, f"{self.path}/v{version}/levels")
        out = fs.create(where, True)
        out.write(bytearray(levels.tobytes()))
        out.close()

    def step(self, number: int, rows: DataFrame) -> DataFrame:
        """(seq,) of rows(seq, value), the micro-batch of that number, which one of the cap rows before is similar or equal to; remembers them.

        With a column number the rows are written and numbered from 0 already.
        """
        before = self._manifest(number)
        buckets, parts = before["buckets"], {int(k): v for k, v in before["parts"].items()}
        value = F.coalesce("value", F.lit(""))
        placed = rows if "number" in rows.columns else numbered(rows.select("seq", "value"), ["seq"], "number", lazy=True)
        placed = placed.select("seq", value.alias("value"), F.md5(value).alias("digest"), (F.col("number") + before["rows"]).alias("number"))
        placed = stored(placed.withColumn("block", F.floor(F.col("number") / self.cap).cast("long")), "numbered-rows")
        n = placed.count()
        if not n:
            self._commit(number, before)
            return rows.select("seq").limit(0)
        strings = placed.groupBy("block", "digest").agg(F.min("number").alias("id"), F.max("number").alias("last"), F.first("value").alias("value"))
        strings = strings.select("id", "last", "block", "digest", tokens(F.col("value")).alias("words"))
        version, part = before["version"], number + 1
        remembered = [p for p, last in parts.items() if last >= before["rows"] - self.cap and p != part]
        if version is None or len(remembered) >= REBUILD:
            old = strings.limit(0) if version is None else self._read(before, "strings", remembered).drop("part")
            old, strings = stored(old, "remembered"), stored(strings, "strings")
            self._anew(number, old, strings, buckets)
            version, kept = number, {0: before["rows"] - 1}
        else:
            kept = {p: parts[p] for p in remembered}
        now = {"rows": before["rows"] + n, "version": version, "buckets": buckets, "parts": kept | {part: before["rows"] + n - 1}, "old": before["version"]}
        ordered = stored(self._ordered(strings, version), "ordered-words")
        self._write(version, part, ordered, buckets)
        hits = stored(self._near(placed, ordered, now, part, before["rows"] - self.cap), "near")
        self._commit(number, now)
        if version == before["version"]:
            for p in set(parts) - set(now["parts"]):
                self._drop(version, p)
            # A version that was replaced one micro-batch ago can't be asked for by a repeat any more.
            if before.get("old") not in (None, version):
                self._forget(before["old"])
        return hits

    def _forget(self, version: int) -> None:
        for what in TABLES:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name(version, what)}")
        fs, folder = fs_path(self.spark, f"{self.path}/v{version}")
        fs.delete(folder, True)

    def _anew(self, version: int, old: DataFrame, new: DataFrame, buckets: int) -> None:
        """A version with fresh frequencies, the remembered strings as its part 0."""
        self._words_of(version, old.select("words").unionByName(new.select("words")))
        ordered = stored(self._ordered(old, version), "ordered-words")
        self._drop(version, 0)
        for what, rows in (("strings", ordered), ("keys", self._keys(ordered).withColumn("h", self._at_block("h", F.col("block"))))):
            self._append(version, what, 0, rows, buckets)

    def candidates(self, ordered: DataFrame, manifest: dict, since: int) -> DataFrame:
        """Distinct (x, y, whole): strings of the micro-batch and earlier ones, in it or remembered with a row of number since or later, that meet on a key."""
        mine = self._keys(ordered).select("h", F.col("id").alias("x"), F.col("n").alias("nx"), F.col("at").alias("ax"), F.col("before").alias("own_before"), "block")
        mine = mine.select(F.explode(F.array(*(self._at_block("h", F.col("block") - k) for k in (0, 1)))).alias("h"), "x", "nx", "ax", "own_before")
        known = self._read(manifest, "keys", list(manifest["parts"])).where(F.col("last") >= since).select("h", F.col("id").alias("y"), F.col("n").alias("ny"), F.col("at").alias("ay"), "before")
        whole = (F.col("ax") == WHOLE) & (F.col("ay") == WHOLE)
        meet = F.when(whole, F.lit(True)).otherwise((F.col("ax") > WHOLE) & (F.col("ay") > WHOLE) & reachable("nx", "ax", "ny", "ay", self.num, self.den))
        return mine.join(known, "h").where((F.col("y") < F.col("x")) & meet).select("x", "y", whole.alias("whole")).distinct()

    def _near(self, placed: DataFrame, ordered: DataFrame, manifest: dict, part: int, since: int) -> DataFrame:
        met = stored(self.candidates(ordered, manifest, since), "candidates")
        known = self._read(manifest, "strings", list(manifest["parts"])).where(F.col("last") >= since).select(F.col("id").alias("y"), F.col("last").alias("y_last"), F.col("block").alias("y_block"), F.col("part").alias("y_part"), F.col("digest").alias("y_digest"), F.col("words").alias("y_words"))
        own = ordered.select(F.col("id").alias("x"), F.col("block").alias("x_block"), F.col("digest").alias("x_digest"), F.col("words").alias("x_words"))
        both = met.join(known, "y").join(own, "x")
        common = F.size(F.array_intersect("x_words", "y_words"))
        either = F.size("x_words") + F.size("y_words") - common
        alike = F.when(F.col("whole"), F.col("x_digest") == F.col("y_digest")).otherwise(common * self.den > either * self.num)
        both = both.where(alike).select("x", "y", "y_last", ((F.col("y_part") == part) & (F.col("y_block") == F.col("x_block"))).alias("same"))
        # Of an earlier group of rows the last one counts; of a group of the same block, where rows of both alternate, the first.
        later = both.select(F.col("x").alias("id"), F.when(~F.col("same"), F.col("y_last")).alias("last"), F.when(F.col("same"), F.col("y")).alias("first"))
        earlier = both.where("same").select(F.col("y").alias("id"), F.lit(None).cast("long").alias("last"), F.col("x").alias("first"))
        equal = ordered if self.blank_equal else ordered.where(F.size("words") > 0)
        itself = equal.select("id", F.lit(None).cast("long").alias("last"), F.col("id").alias("first"))
        marks = later.unionByName(earlier).unionByName(itself).groupBy("id").agg(F.max("last").alias("last"), F.min("first").alias("first"))
        groups = ordered.select("id", "block", "digest").join(marks, "id").drop("id")
        hit = (F.col("number") - F.col("last") <= self.cap) | (F.col("first") < F.col("number"))
        return placed.select("seq", "number", "block", "digest").join(groups, ["block", "digest"]).where(F.coalesce(hit, F.lit(False))).select("seq")
