"""Op 9, Jaccard join of documents on word n-grams: rare-first prefix filter with length, positional and suffix filters.

1. One pass gives each document's set of distinct n-grams (64-bit hashes), a key of the set, and a count sketch of
   how often n-grams occur over all documents. Equal sets are one class from here on.
2. Rare first: n-grams are ordered by (sketch count, hash), the same order everywhere. Two sets with Jaccard >= t share
   one of their first n - ceil(t n) + 1 n-grams. Those prefix entries are grouped by hash; the sketch names hot hashes
   beforehand, whose groups are salted. Groups of one class vanish.
3. Each group names one centre, and (centre, member) are the candidates: linear in the group, not quadratic. After the
   length, positional and suffix filters each candidate is verified once against the whole sets.
4. Verified links give components. A group whose classes are all in one component has no more to say; for the others
   the pairs across components are candidates in turn (first again by centres while they are many), until nothing is
   left. So no link between two different sets can be missed, and copies are never paired up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.llm.common import blocks, column_bytes, column_list, table, written

#: Words of an n-gram; links need 100 * intersection >= PERCENT * union.
NGRAM, PERCENT = 5, 75
#: Slots of the count sketch (4 bytes each, sent to all tasks), in chunks for the shuffle that adds it up.
SLOT_BITS, CHUNK = 20, 1 << 14
#: Entries of a hash, by the sketch, beyond which its group is salted.
SALT_ROWS = 4096
#: Hash ranges of the suffix filter; most bits of the filter that picks the sets to send for verification (beyond some
#: millions of candidate classes it lets more and more sets pass that no pair needs, which costs time but loses nothing).
RANGES, MAX_PICK_BITS = 64, 22
#: Pairs across components that are tried at once, as a multiple of the entries, and rounds by centres before.
PAIRS_PER_ENTRY, CENTRE_ROUNDS = 64, 3

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_WORDS_KEPT = 400_000


class NgramHasher:
    """Sets of distinct n-gram hashes of texts. Words are cut at ASCII white space after lower-casing A-Z."""

    def __init__(self, ngram: int = NGRAM):
        self.ngram = ngram
        self.hash_of: dict[bytes, int] = {}

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        """A sorted array of unsigned 64-bit hashes per text. A text of fewer words has one n-gram, its whole sequence;
        a text without words has none."""
        if len(self.hash_of) > _WORDS_KEPT:
            self.hash_of.clear()
        cut = [t.translate(_LOWER).split() for t in texts]
        known, digest = self.hash_of, xxhash.xxh3_64_intdigest
        for w in set().union(*cut).difference(known):
            known[w] = digest(w)
        flat = np.fromiter((known[w] for words in cut for w in words), np.uint64, sum(map(len, cut)))
        grams = _fold([flat[k : len(flat) - self.ngram + 1 + k] for k in range(self.ngram)]) if len(flat) >= self.ngram else flat[:0]
        out, start = [], 0
        for words in cut:
            n = len(words)
            if n >= self.ngram:
                out.append(np.unique(grams[start : start + n - self.ngram + 1]))
            else:
                out.append(_fold([flat[start + k : start + k + 1] for k in range(n)]) if n else flat[:0])
            start += n
        return out


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _fold(parts: list[np.ndarray]) -> np.ndarray:
    """Hash of a sequence of hashes, for many sequences at once; the length counts too."""
    total = np.full(len(parts[0]), len(parts), np.uint64)
    for p in parts:
        total = _mix(total * np.uint64(0x9E3779B97F4A7C15) + p)
    return total


def set_key(grams: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(grams.tobytes()) - (1 << 63)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


_SUMMARY = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("mark", T.LongType()),
    T.StructField("n", T.LongType()),
    T.StructField("key", T.LongType()),
    T.StructField("ranges", T.ArrayType(T.IntegerType())),
    T.StructField("chunk", T.IntegerType()),
    T.StructField("counts", T.BinaryType()),
])


def _summaries(ngram: int):
    """Per document: set size, key and sizes by hash range; per task: the non-zero chunks of its count sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, sketch = NgramHasher(ngram), np.zeros(1 << SLOT_BITS, np.uint32)
        for block in blocks(batches, "text"):
            sets = hasher.sets(column_bytes(block, "text"))
            n = len(sets)
            sketch += np.bincount(np.concatenate(sets) >> np.uint64(64 - SLOT_BITS), minlength=len(sketch)).astype(np.uint32)
            yield pa.RecordBatch.from_pydict({
                "doc_id": block.column(0),
                "mark": block.column(2),
                "n": pa.array([len(s) for s in sets], pa.int64()),
                "key": pa.array([set_key(s) if len(s) else None for s in sets], pa.int64()),
                "ranges": pa.array([np.bincount(s >> np.uint64(58), minlength=RANGES).astype(np.int32) for s in sets], pa.list_(pa.int32())),
                "chunk": pa.nulls(n, pa.int32()),
                "counts": pa.nulls(n, pa.binary()),
            })
        parts = [(k, c) for k, c in enumerate(sketch.reshape(-1, CHUNK)) if c.any()]
        if parts:
            n = len(parts)
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.nulls(n, pa.int64()),
                "mark": pa.nulls(n, pa.int64()),
                "n": pa.nulls(n, pa.int64()),
                "key": pa.nulls(n, pa.int64()),
                "ranges": pa.nulls(n, pa.list_(pa.int32())),
                "chunk": pa.array([k for k, _ in parts], pa.int32()),
                "counts": pa.array([c.tobytes() for _, c in parts], pa.binary()),
            })

    return run


def _add_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, raw in zip(column_list(batch, "chunk"), column_list(batch, "counts")):
            counts = np.frombuffer(raw, np.uint32).astype(np.uint64)
            totals[k] = totals[k] + counts if k in totals else counts
    yield pa.RecordBatch.from_pydict({
        "chunk": pa.array(list(totals), pa.int32()),
        "counts": pa.array([np.minimum(c, 0xFFFFFFFF).astype(np.uint32).tobytes() for c in totals.values()], pa.binary()),
    })


_ENTRY = T.StructType([
    T.StructField("gram", T.LongType()),
    T.StructField("salt", T.IntegerType()),
    T.StructField("salted", T.BooleanType()),
    T.StructField("key", T.LongType()),
    T.StructField("n", T.IntegerType()),
    T.StructField("pos", T.IntegerType()),
])


def _entries(ngram: int, percent: int, sketch):
    """Prefix entries of every set, once per block for equal sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, counts = NgramHasher(ngram), sketch.value
        for block in blocks(batches, "text"):
            seen, grams, keys, sizes, places = set(), [], [], [], []
            for s in hasher.sets(column_bytes(block, "text")):
                n = len(s)
                if not n or (key := set_key(s)) in seen:
                    continue
                seen.add(key)
                prefix = n + (-n * percent // 100) + 1  # n - ceil(n t) + 1
                rarest = np.lexsort((s, counts[s >> np.uint64(64 - SLOT_BITS)]))[:prefix]
                grams.append(s[rarest])
                keys.append(np.full(prefix, key))
                sizes.append(np.full(prefix, n, np.int32))
                places.append(np.arange(prefix, dtype=np.int32))
            if not grams:
                continue
            gram, key = np.concatenate(grams), np.concatenate(keys)
            salts = counts[gram >> np.uint64(64 - SLOT_BITS)] // SALT_ROWS + 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(_signed(gram)),
                    pa.array((key.view(np.uint64) % salts.astype(np.uint64)).astype(np.int32)),
                    pa.array(salts > 1),
                    pa.array(key),
                    pa.array(np.concatenate(sizes)),
                    pa.array(np.concatenate(places)),
                ],
                names=[f.name for f in _ENTRY],
            )

    return run


_SET = T.StructType([T.StructField("key", T.LongType()), T.StructField("grams", T.BinaryType())])


def _sets(ngram: int, pick):
    """Sets of the documents picked by id (a Bloom bitmap: others may come along)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, bits = NgramHasher(ngram), pick.value
        for block in blocks(batches, "text"):
            ids = block.column(0).to_pandas().to_numpy(dtype="float64", na_value=np.nan)
            known = block.column(0).is_valid().to_numpy(zero_copy_only=False)
            at = _slot(np.array(column_list(block.filter(pa.array(known)), "doc_id"), np.int64), len(bits))
            wanted = np.ones(len(ids), bool)
            wanted[known] = bits[at]
            part = block.filter(pa.array(wanted))
            if part.num_rows:
                found = {set_key(s): s for s in hasher.sets(column_bytes(part, "text")) if len(s)}
                yield pa.RecordBatch.from_pydict({
                    "key": pa.array(list(found), pa.int64()),
                    "grams": pa.array([s.tobytes() for s in found.values()], pa.binary()),
                })

    return run


def _slot(ids: np.ndarray, slots: int) -> np.ndarray:
    return (_mix(ids.view(np.uint64)) % np.uint64(slots)).astype(np.int64)


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "y_grams"):
            good, last, grams = [], None, None
            for x, gx, gy in zip(column_list(block, "x"), column_list(block, "x_grams"), column_list(block, "y_grams")):
                if x != last:
                    last, grams = x, np.frombuffer(gx, np.uint64)
                other = np.frombuffer(gy, np.uint64)
                common = len(np.intersect1d(grams, other, assume_unique=True))
                good.append(100 * common >= percent * (len(grams) + len(other) - common))
            yield block.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return run


class NgramJoin:
    """The join over one frame of documents; ``components()`` is what queries use."""

    def __init__(self, docs: DataFrame, ngram: int = NGRAM, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text", marked: bool = False):
        """``marked``: rows keep a hash of their text, to be told from others of the same id."""
        self.spark, self.ngram, self.percent = docs.sparkSession, ngram, percent
        self.docs = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))
        rows = self.docs.withColumn("mark", F.xxhash64("text") if marked else F.lit(None).cast("long"))
        both = written(rows.mapInArrow(_summaries(ngram), _SUMMARY), "ngram-summaries")
        self.summaries = both.where("chunk is null").select("doc_id", "mark", "n", "key", "ranges")
        self.classes = self.summaries.where("key is not null").groupBy("key").agg(F.min("doc_id").alias("first_id"), F.first("n").alias("n"), F.first("ranges").alias("ranges"))
        chunks = both.where("chunk is not null").select("chunk", "counts").repartition("chunk").mapInArrow(_add_chunks, "chunk int, counts binary").collect()
        sketch = np.zeros(1 << SLOT_BITS, np.uint32)
        for r in chunks:  # a fixed number of chunks, 4 MB in all
            sketch[r["chunk"] * CHUNK : (r["chunk"] + 1) * CHUNK] = np.frombuffer(r["counts"], np.uint32)
        self.entries = self._shared_entries(self.spark.sparkContext.broadcast(sketch))

    def _shared_entries(self, sketch) -> DataFrame:
        """Prefix entries of the n-grams that more than one class has in its prefix, with the centre of their group: the
        class with the fewest rarer n-grams, which among copies with different edits is the least edited one."""
        group = Window.partitionBy("gram", "salt")
        found = (
            self.docs.mapInArrow(_entries(self.ngram, self.percent, sketch), _ENTRY)
            .withColumn("low", F.min("key").over(group))
            .withColumn("high", F.max("key").over(group))
            .withColumn("centre", F.min(F.struct("pos", "key")).over(group))
        )
        # a salted group may have its other classes under other salts
        kept = found.where((F.col("low") != F.col("high")) | F.col("salted")).select("gram", "salted", "key", "n", "pos", "centre")
        return written(kept, "ngram-entries")

    def _candidates(self, pairs: DataFrame, done: DataFrame | None) -> DataFrame:
        """Distinct pairs (x < y) of different classes, not tried before, that pass the length and suffix filters."""
        pairs = pairs.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y")).where("x < y").distinct()
        if done is not None:
            pairs = pairs.join(done, ["x", "y"], "left_anti")
        side = lambda v: self.classes.select(F.col("key").alias(v), F.col("n").alias(f"n{v}"), F.col("ranges").alias(f"r{v}"))
        need = F.ceil((F.col("nx") + F.col("ny")) * self.percent / (100 + self.percent) - F.lit(1e-9))
        most = F.aggregate(F.zip_with("rx", "ry", lambda a, b: F.least(a, b)), F.lit(0), lambda a, b: a + b)
        return (
            pairs.join(side("x"), "x").join(side("y"), "y")
            .where((F.col("nx") * 100 >= F.col("ny") * self.percent) & (F.col("ny") * 100 >= F.col("nx") * self.percent) & (most >= need))
            .select("x", "y")
        )

    def _verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose whole sets reach the threshold. Sets go only of classes that a pair names."""
        used = pairs.select(F.col("x").alias("key")).union(pairs.select(F.col("y").alias("key"))).distinct().join(self.classes.select("key", "first_id"), "key").select("first_id").where("first_id is not null")
        slots = 1 << min(MAX_PICK_BITS, max(10, (32 * pairs.count()).bit_length()))
        bits = np.zeros(slots, bool)
        bits[used.mapInArrow(_slots_of(slots), "slot long").distinct().toPandas()["slot"].to_numpy(np.int64)] = True
        sets = self.docs.mapInArrow(_sets(self.ngram, self.spark.sparkContext.broadcast(bits)), _SET)
        sets = written(sets, "ngram-sets").groupBy("key").agg(F.first("grams").alias("grams"))
        both = (
            pairs.join(sets.select(F.col("key").alias("y"), F.col("grams").alias("y_grams")), "y")
            .join(sets.select(F.col("key").alias("x"), F.col("grams").alias("x_grams")), "x")
            .select("x", "y", "x_grams", "y_grams")
        )
        return both.mapInArrow(_verify(self.percent), "x long, y long")

    def links(self) -> tuple[DataFrame, DataFrame]:
        """Links that connect all components, and (key, component) of the classes with links."""
        e = self.entries
        pairs = e.select(F.col("centre.key").alias("a"), F.col("key").alias("b"))
        parts = e.where("salted").select("gram", "centre").distinct()
        tops = parts.groupBy("gram").agg(F.min("centre").alias("top"))
        pairs = pairs.union(parts.join(tops, "gram").select(F.col("top.key").alias("a"), F.col("centre.key").alias("b")))
        tried = written(self._candidates(pairs, None), "ngram-pairs")
        links = written(self._verified(tried), "ngram-links")
        label = components(links, "x", "y")
        for turn in range(CENTRE_ROUNDS + 1):
            still_open = written(self._open_entries(label), "ngram-open")
            entries = still_open.count()
            if not entries:
                break
            last = turn == CENTRE_ROUNDS or self._pair_count(still_open) <= PAIRS_PER_ENTRY * entries
            more = written(self._candidates(self._pairs_across(still_open, last, turn), tried), "ngram-pairs")
            if not more.isEmpty():
                tried = tried.union(more)
                found = written(self._verified(more), "ngram-links")
                if not found.isEmpty():
                    links = links.union(found)
                    label = components(links, "x", "y")
            if last:
                break
        return links, label

    def _open_entries(self, label: DataFrame) -> DataFrame:
        """Entries of the n-grams whose classes are in more than one component."""
        e = self.entries.select("gram", "key", "n", "pos").join(label, "key", "left").withColumn("component", F.coalesce("component", "key"))
        mixed = e.groupBy("gram").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high").select("gram")
        return e.join(mixed, "gram", "left_semi")

    @staticmethod
    def _pair_count(e: DataFrame) -> float:
        sizes = e.groupBy("gram", "component").agg(F.count(F.lit(1)).alias("c")).groupBy("gram").agg(F.sum("c").alias("g"), F.sum(F.col("c") * F.col("c")).alias("s"))
        return sizes.agg(F.coalesce(F.sum((F.col("g") * F.col("g") - F.col("s")) / 2), F.lit(0.0)).alias("p")).first()["p"]

    def _pairs_across(self, e: DataFrame, all_pairs: bool, turn: int) -> DataFrame:
        """Pairs of classes of one n-gram in different components: all that pass the length and positional filters,
        or each class with one centre of its group, from another component in each turn."""
        if not all_pairs:
            centre = e.groupBy("gram").agg(F.min(F.struct(F.xxhash64("component", F.lit(turn)).alias("h"), "pos", "key", "component")).alias("c"))
            return e.join(centre, "gram").where(F.col("component") != F.col("c.component")).select(F.col("c.key").alias("a"), F.col("key").alias("b"))
        x = e.select("gram", F.col("key").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa"), F.col("component").alias("ca"))
        y = e.select("gram", F.col("key").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"), F.col("component").alias("cb"))
        need = F.ceil((F.col("na") + F.col("nb")) * self.percent / (100 + self.percent) - F.lit(1e-9))
        # the bound holds at the first n-gram that both share, so a linked pair passes at least there
        return (
            x.join(y, "gram")
            .where((F.col("ca") < F.col("cb")) & (F.col("na") * 100 >= F.col("nb") * self.percent) & (F.col("nb") * 100 >= F.col("na") * self.percent))
            .where(F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) >= need)
            .select("a", "b")
        )

    def components_of_rows(self) -> DataFrame:
        """One row per document row with n-grams: doc_id, mark, n_shingles, component (a key)."""
        _, label = self.links()
        of_class = self.classes.select("key").join(label, "key", "left").select("key", F.coalesce("component", "key").alias("component"))
        return self.summaries.join(of_class, "key").select("doc_id", "mark", F.col("n").alias("n_shingles"), "component")

    def components(self) -> DataFrame:
        """One row per document row: doc_id, n_shingles, component_id."""
        _, label = self.links()
        first = (
            self.classes.select("key", "first_id").join(label, "key", "left")
            .select("key", "first_id", F.coalesce("component", "key").alias("component"))
        )
        least = first.groupBy("component").agg(F.min("first_id").alias("component_id"))
        of_class = first.join(least, "component").select("key", "component_id")
        return self.summaries.join(of_class, "key", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def _slots_of(slots: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.array(column_list(batch, "first_id"), np.int64)
            yield pa.RecordBatch.from_pydict({"slot": pa.array(np.unique(_slot(ids, slots)), pa.int64())})

    return run


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(key, component) for every node of some link; the component is its smallest node.

    Smallest labels spread over links and along the labels themselves, each turn written to the shared folder, until
    nothing changes. Sums by node are hash aggregates with a partial step, so a hub costs no single task its links.
    """
    edges = written(links.select(F.col(a).alias("u"), F.col(b).alias("v")).union(links.select(F.col(b).alias("u"), F.col(a).alias("v"))).distinct(), "component-edges")
    label = written(edges.groupBy(F.col("u").alias("key")).agg(F.least(F.min("v"), F.first("u")).alias("component")), "component-labels")
    while True:
        near = edges.join(label, edges["v"] == label["key"]).groupBy("u").agg(F.min("component").alias("near"))
        step = label.join(near, label["key"] == near["u"]).select("key", F.col("component").alias("was"), F.least("component", "near").alias("component"))
        jump = label.select(F.col("key").alias("component"), F.col("component").alias("further"))
        new = written(step.join(jump, "component", "left").select("key", "was", F.least("component", "further").alias("component")), "component-labels")
        label = new.select("key", "component")
        if new.where("was != component").isEmpty():
            return label


def near_duplicates(docs: DataFrame, ngram: int = NGRAM, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row: doc_id, n_shingles (size of its n-gram set) and component_id, the smallest doc_id
    reachable over links (100 * intersection >= percent * union).

    Null, empty or word-less texts have no n-grams and stand alone. A text of fewer words than an n-gram has its whole
    sequence as its one n-gram. Repeated rows are equal sets and so in one component. A null doc_id takes part, but
    never names a component. Other columns are not read.
    """
    return NgramJoin(docs, ngram, percent, id_col, text_col).components()


def _unused(name: str, names: list[str]) -> str:
    """``name``, with underscores added until no column has it."""
    while name.lower() in {n.lower() for n in names}:
        name += "_"
    return name


def keep_one(docs: DataFrame, ngram: int = NGRAM, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns as they are, with one of each component: the one of the smallest id (of several texts
    under that id, the one with the smallest hash).

    A row is known by its id and a 64-bit hash of its text, so an id that repeats under different texts loses none that is
    unique. Of rows equal in both, one stays. Documents without n-grams or without an id all stay.
    """
    join = NgramJoin(docs, ngram, percent, id_col, text_col, marked=True)
    found = join.components_of_rows().where("n_shingles > 0 and doc_id is not null")
    stays = found.groupBy("component").agg(F.min(F.struct("doc_id", "mark")).alias("one"))
    # one row a component on the other side, so a hot component is split like any skewed join
    gone = found.join(stays, "component").where((F.col("doc_id") != F.col("one.doc_id")) | (F.col("mark") != F.col("one.mark"))).select("doc_id", "mark").distinct()
    names = docs.columns
    of_id, mark, rank, alone = (_unused(n, names) for n in ("_id", "_mark", "_rank", "_alone"))
    gone = gone.select(F.col("doc_id").alias(of_id), F.col("mark").alias(mark))
    rows = docs.withColumns({of_id: docs[id_col].cast("long"), mark: F.xxhash64(docs[text_col].cast("string"))})
    kept = rows.join(gone, [of_id, mark], "left_anti")
    # rows that all stay are numbered, so that none of them meet in the window
    single = docs[id_col].isNull() | ~F.coalesce(docs[text_col].cast("string").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    kept = kept.withColumn(alone, F.when(single, F.monotonically_increasing_id()))
    copies = Window.partitionBy(of_id, mark, alone).orderBy(F.lit(0))
    return kept.withColumn(rank, F.row_number().over(copies)).where(F.col(rank) == 1).select(*names)


def op9(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"))


ORACLE = """
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
gram AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + least(5, len(w)) - 1), ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - least(5, len(w)) + 1)) AS i FROM doc WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM gram GROUP BY doc_id),
pair AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM gram a JOIN gram b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
link AS (
  SELECT x, y FROM pair JOIN size sx ON sx.doc_id = x JOIN size sy ON sy.doc_id = y
  WHERE 100 * c >= 75 * (sx.n + sy.n - c)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM doc
  UNION
  SELECT reach.a, link.y AS b FROM reach JOIN link ON link.x = reach.b)
SELECT doc.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM doc LEFT JOIN size ON size.doc_id = doc.doc_id
JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) r ON r.a = doc.doc_id
"""
