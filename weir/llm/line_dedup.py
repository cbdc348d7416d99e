"""Reversible line dedup: sharded cuckoo filters in front of exact reference-count tables.

A line's key is the line without white space at both ends, A-Z in lower case; keys of at least min_chars code points
count. A key that is found in at least min_docs documents is active: all its lines go, except in the document of the
largest doc_id that holds it (the keeper).

LineIndex keeps, below one folder in shared storage,
  references  (h1, h2, doc_id): one row for each key and document
  counts      (shard, h1, h2, n_docs, keeper): exact reference counts
  filters     (shard, bits): a cuckoo filter of the active keys of the shard
insert() adds the references of new documents and their counts; delete() takes references away and counts the keys
that lost one again. A key whose count reaches min_docs enters its shard's filter, and one whose count falls below
leaves it: texts never change, so every decision can be undone. Each change writes a new version of what it changes; a
failed or repeated job never touches the version in use.

Keys are 128-bit hashes; a shard is a residue of the first half, so that shards are even, and their number follows the
number of keys, so that a filter stays small. Lines probe the filters first; only the few that a filter lets through
meet the exact table, which drops the filter's false positives. While filters and the exact table's active keys are at most
max_filter_bytes each, both are broadcast, and a document loses its lines where it lies: no text is moved. Beyond that
the lines that pass are joined with the exact table, and the texts with their lists of lines to drop; filters beyond the
bound are dealt out, and the lines to their shards. Active keys of very many documents are joined apart, by broadcast: at
most references / hot_docs keys can have hot_docs references.

Defined cases: a null text is an empty text, with one empty line; an empty table has no keys; rows that share a doc_id
count as one document and lose the same lines, so that the keeper's rows all keep theirs; null doc_ids count as one
document, the smallest; a text of any length is read whole, by one worker, and its keys leave it once each; other columns
stay as they are, but for n_lines and n_dropped, which are the result's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weir.llm.common import dealt, map_batches, text_bytes
from weir.sources.shared import scratch

MIN_CHARS = 40
MIN_DOCS = 5
KEYS_PER_SHARD = 200_000
MAX_FILTER_BYTES = 32 << 20
MAX_HOT_KEYS = 10_000
#: Bytes of an active key with its keeper.
ACTIVE_BYTES = 24
#: Lines of a shard that meet its filter in one task, where filters are dealt out.
ROWS_PER_TASK = 2_000_000
#: Bytes of a line's hash and document where they meet.
REFERENCE_BYTES = 40
#: Columns of apply_index for its own use.
OF_DOC, DROP = "__weir_of_doc", "__weir_drop"

_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
_CONTINUATION = bytes(range(0x80, 0xC0))


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> tuple[int, int] | None:
    """The two signed halves of the 128-bit hash of a line's key; None if the key is too short."""
    key = line.strip(_SPACE)
    if len(key) < min_chars or len(key) < 4 * min_chars and len(key.translate(None, _CONTINUATION)) < min_chars:
        return None
    digest = xxhash.xxh3_128_digest(key.lower())
    return int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; a key's second bucket is the first xor a hash of its fingerprint."""

    SLOTS = 4

    def __init__(self, table: np.ndarray):
        self.table = table

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        buckets = 1 << max(2, int(np.ceil(np.log2(max(1, keys) / (cls.SLOTS * 0.8)))))
        return cls(np.zeros((buckets, cls.SLOTS), np.uint16))

    @classmethod
    def of(cls, keys: np.ndarray) -> CuckooFilter:
        """A filter of distinct 64-bit keys; doubled for as long as one does not fit."""
        size = len(keys)
        while True:
            made = cls.sized(size)
            if all(made.insert(int(k)) for k in keys.view(np.uint64)):
                return made
            size = 2 * max(1, size)

    @classmethod
    def from_bytes(cls, bits: bytes) -> CuckooFilter:
        return cls(np.frombuffer(bits, np.uint16).reshape(-1, cls.SLOTS).copy())

    def to_bytes(self) -> bytes:
        return self.table.tobytes()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys = np.asarray(keys).astype(np.uint64, copy=False)
        mask = np.uint64(len(self.table) - 1)
        prints = (keys >> np.uint64(48)) % np.uint64(65_535) + np.uint64(1)
        first = (keys >> np.uint64(8)) & mask
        return prints, first, first ^ (self._spread(prints) & mask)

    @staticmethod
    def _spread(prints: np.ndarray) -> np.ndarray:
        return (prints * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(24)

    def contains(self, keys: np.ndarray) -> np.ndarray:
        prints, first, second = self._places(keys)
        wanted = prints.astype(np.uint16)[:, None]
        return (self.table[first] == wanted).any(1) | (self.table[second] == wanted).any(1)

    def insert(self, key: int) -> bool:
        prints, first, second = (int(x[0]) for x in self._places(np.array([key], np.uint64)))
        mask, at = len(self.table) - 1, first
        for place in (first, second):
            free = np.flatnonzero(self.table[place] == 0)
            if len(free):
                self.table[place, free[0]] = prints
                return True
        for kick in range(500):
            slot = (kick * 7 + prints) % self.SLOTS
            prints, self.table[at, slot] = int(self.table[at, slot]), prints
            at ^= int(self._spread(np.array([prints], np.uint64))[0]) & mask
            free = np.flatnonzero(self.table[at] == 0)
            if len(free):
                self.table[at, free[0]] = prints
                return True
        return False

    def delete(self, key: int) -> bool:
        prints, first, second = (int(x[0]) for x in self._places(np.array([key], np.uint64)))
        for place in (first, second):
            found = np.flatnonzero(self.table[place] == prints)
            if len(found):
                self.table[place, found[0]] = 0
                return True
        return False


def _reference_batches(batches: Iterator[pa.RecordBatch], min_chars: int, probe) -> Iterator[pa.RecordBatch]:
    """(h1, h2, doc_id) of each distinct key of a row; with probe, of those that the filters let through."""
    for batch in batches:
        ids, h1, h2 = [], [], []
        for at, text in enumerate(text_bytes(batch.column(1))):
            keys = {k for k in (line_key(x, min_chars) for x in text.split(b"\n") if len(x) >= min_chars) if k}
            for a, b in keys:
                ids.append(at)
                h1.append(a)
                h2.append(b)
        columns = [pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), batch.column(0).take(pa.array(ids, pa.int64()))]
        rows = pa.record_batch(columns, ["h1", "h2", "doc_id"])
        yield rows if probe is None else rows.filter(pa.array(_passes(rows, probe.value)))


def _passes(rows: pa.RecordBatch, filters: list[bytes]) -> np.ndarray:
    """Whether the filter of each row's shard holds its key."""
    h1, h2 = rows.column(0).to_numpy(), rows.column(1).to_numpy()
    held, shard = np.zeros(len(rows), bool), np.mod(h1, len(filters))
    for s in np.unique(shard):
        of = np.flatnonzero(shard == s)
        if filters[s]:
            held[of] = _opened(filters[s]).contains(h2[of].view(np.uint64))
    return held


_open: dict[int, tuple[bytes, CuckooFilter]] = {}


def _opened(bits: bytes) -> CuckooFilter:
    if id(bits) not in _open:
        if len(_open) > 4096:
            _open.clear()
        _open[id(bits)] = (bits, CuckooFilter.from_bytes(bits))
    return _open[id(bits)][1]


def references(docs: DataFrame, min_chars: int = MIN_CHARS, probe=None) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_batches(rows, lambda b: _reference_batches(b, min_chars, probe), "h1 long, h2 long, doc_id long")


def _build_filter(key: tuple, table: pa.Table) -> pa.Table:
    keys = np.unique(table.column("h2").to_numpy())
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([CuckooFilter.of(keys).to_bytes()], pa.binary())})


def _update_filter(key: tuple, old: pa.Table, change: pa.Table) -> pa.Table:
    """The shard's filter after its keys' changes: entered is true for a key that became active, false for one that left."""
    if not old.num_rows:
        entered = change.filter(change.column("entered"))
        return _build_filter(key, entered).slice(0, 1 if entered.num_rows else 0)
    filt = CuckooFilter.from_bytes(old.column("bits")[0].as_py())
    keys, entered = change.column("h2").to_numpy().view(np.uint64), change.column("entered").to_pylist()
    for k, new in zip(keys.tolist(), entered, strict=True):
        if not new:
            filt.delete(k)
    full = any(not filt.insert(k) for k, new in zip(keys.tolist(), entered, strict=True) if new)
    bits = None if full else filt.to_bytes()
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([bits], pa.binary())})


class LineIndex:
    """The incremental state: see the module's text."""

    def __init__(self, spark: SparkSession, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, shards: int | None = None):
        self.spark, self.min_chars, self.min_docs, self.shards = spark, min_chars, min_docs, shards
        self.root = scratch(spark, "lines")
        self.version = 0
        self.counts: DataFrame | None = None
        self.filters: DataFrame | None = None
        self.references: DataFrame | None = None
        self.n_references = 0

    def _write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/v{self.version}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _count(self, refs: DataFrame) -> DataFrame:
        # partial counts meet, not references, whatever a key's share of the documents
        return refs.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("keeper"))

    def _sharded(self, counts: DataFrame) -> DataFrame:
        return counts.select(F.pmod(F.col("h1"), F.lit(self.shards)).cast("int").alias("shard"), "h1", "h2", "n_docs", "keeper")

    def insert(self, docs: DataFrame) -> LineIndex:
        """Adds documents. One whose doc_id the index has already changes nothing: delete it first."""
        self.version += 1
        if self.references is None:
            self.references = self._write(references(docs, self.min_chars).distinct(), "references")
            self.n_references = self.references.count()
            self.shards = self.shards or max(1, -(-self.n_references // KEYS_PER_SHARD))
            self.counts = self._write(self._sharded(self._count(self.references)), "counts")
            built = self.active().groupBy("shard").applyInArrow(_build_filter, "shard int, bits binary")
            self.filters = self._write(built, "filters")
            return self
        had = self.references.select(F.col("doc_id").alias("had")).distinct()
        new = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        new = new.join(had, new["doc_id"].eqNullSafe(had["had"]), "left_anti")
        added = self._write(references(new, self.min_chars).distinct(), "references")
        self.references = self.references.union(added)
        self.n_references += added.count()
        merged = self.counts.select("h1", "h2", "n_docs", "keeper").union(self._count(added))
        merged = merged.groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.max("keeper").alias("keeper"))
        return self._changed(merged)

    def delete(self, doc_ids: DataFrame) -> LineIndex:
        """Takes the documents named by doc_id away."""
        if self.references is None:
            return self
        self.version += 1
        gone = doc_ids.select(F.col("doc_id").cast("long").alias("gone")).distinct()
        same = self.references["doc_id"].eqNullSafe(gone["gone"])
        lost = self._write(self.references.join(gone, same, "left_semi").select("h1", "h2").distinct(), "lost")
        self.references = self._write(self.references.join(gone, same, "left_anti"), "references")
        self.n_references = self.references.count()
        own = self.counts.select("h1", "h2", "n_docs", "keeper")
        again = self._count(self.references.join(lost, ["h1", "h2"], "left_semi"))
        return self._changed(own.join(lost, ["h1", "h2"], "left_anti").union(again))

    def _changed(self, counts: DataFrame) -> LineIndex:
        before = self.active()
        self.counts = self._write(self._sharded(counts), "counts")
        was = before.select("shard", "h1", "h2", F.lit(True).alias("was"))
        now = self.active().select("shard", "h1", "h2", F.lit(True).alias("now"))
        change = was.join(now, ["shard", "h1", "h2"], "full_outer").where("was is null or now is null")
        change = change.select("shard", "h2", F.col("now").isNotNull().alias("entered"))
        changed = self.filters.groupBy("shard").cogroup(change.groupBy("shard"))
        changed = self._write(changed.applyInArrow(_update_filter, "shard int, bits binary"), "changed")
        full = changed.where("bits is null").select("shard")
        rebuilt = self.active().join(full, "shard", "left_semi").groupBy("shard").applyInArrow(_build_filter, "shard int, bits binary")
        self.filters = self._write(changed.where("bits is not null").union(rebuilt), "filters")
        return self

    def active(self) -> DataFrame:
        return self.counts.where(F.col("n_docs") >= self.min_docs)

    def _small_filters(self, max_bytes: int):
        """All filters, broadcast, by shard; None if they are larger."""
        size = self.filters.agg(F.sum(F.octet_length("bits"))).first()[0] or 0
        if size > max_bytes:
            return None
        bits: list[bytes] = [b""] * self.shards
        for row in self.filters.collect():
            bits[row["shard"]] = bytes(row["bits"])
        return self.spark.sparkContext.broadcast(bits)

    def broadcast(self, max_bytes: int = MAX_FILTER_BYTES):
        """Filters and active keys, broadcast; None if either is larger. A key of null doc_ids alone has no keeper."""
        active = self.active().select("h1", "h2", "keeper")
        n = active.count()
        if n * ACTIVE_BYTES > max_bytes or self.min_docs < 2 or (filters := self._small_filters(max_bytes)) is None:
            return None
        table = active.toArrow()
        return filters, self.spark.sparkContext.broadcast(_Active(*(table.column(c).to_numpy() for c in ("h1", "h2", "keeper"))))

    def candidates(self, docs: DataFrame, max_filter_bytes: int = MAX_FILTER_BYTES, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
        """(h1, h2, doc_id) of the documents' lines that the filters let through."""
        if (bits := self._small_filters(max_filter_bytes)) is not None:
            return references(docs, self.min_chars, bits)
        rows = references(docs, self.min_chars)
        rows = rows.withColumn("shard", F.pmod(F.col("h1"), F.lit(self.shards)).cast("int"))
        # beyond a broadcast's bound: parts of the lines of a shard, as many as its references ask for, meet its filter
        parts = F.greatest(F.lit(1), F.ceil(F.sum("n_docs") / rows_per_task)).cast("int")
        parts = self.counts.groupBy(F.col("shard").alias("of")).agg(parts.alias("parts"))
        rows = rows.join(parts, F.col("shard") == F.col("of")).withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"))
        rows = rows.select("shard", "salt", "h1", "h2", "doc_id")
        filters = self.filters.join(parts, F.col("shard") == F.col("of")).select("shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"), "bits")

        def pass_lines(key: tuple, lines: pa.Table, filters: pa.Table) -> pa.Table:
            lines = lines.select(["h1", "h2", "doc_id"])
            if not filters.num_rows or not lines.num_rows:
                return lines.slice(0, 0)
            held = CuckooFilter.from_bytes(filters.column("bits")[0].as_py()).contains(lines.column("h2").to_numpy().view(np.uint64))
            return lines.filter(pa.array(held))

        rows, filters = (dealt(x, REFERENCE_BYTES * self.n_references, "shard", "salt").groupBy("shard", "salt") for x in (rows, filters))
        return rows.cogroup(filters).applyInArrow(pass_lines, "h1 long, h2 long, doc_id long")

    def dropped(self, docs: DataFrame, max_hot_keys: int = MAX_HOT_KEYS, **options) -> DataFrame:
        """(doc_id, drop: the keys' halves) of the documents that lose lines, after the exact check."""
        rows = self.candidates(docs, **options)
        active = self.active().select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), "n_docs", "keeper")
        hot_docs = max(1000, -(-self.n_references // max_hot_keys))  # so many references at most max_hot_keys keys have
        hot, rest = active.where(F.col("n_docs") >= hot_docs), active.where(F.col("n_docs") < hot_docs)
        same = (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2"))
        rows = rows.join(F.broadcast(hot.withColumnsRenamed({"k1": "a1", "k2": "a2", "n_docs": "a", "keeper": "hot_keeper"})), (F.col("h1") == F.col("a1")) & (F.col("h2") == F.col("a2")), "left")
        of_hot = rows.where(F.col("a").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("hot_keeper")))
        of_rest = rows.where(F.col("a").isNull()).select("h1", "h2", "doc_id").join(rest, same)
        of_rest = of_rest.where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        drops = of_hot.select("doc_id", "h1", "h2").union(of_rest.select("doc_id", "h1", "h2"))
        return drops.groupBy("doc_id").agg(F.collect_set(F.struct("h1", "h2")).alias("drop"))


def _apply_batches(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        names = batch.schema.names
        kept, n_lines, n_dropped = [], [], []
        for text, drop in zip(text_bytes(batch.column(names.index("text"))), batch.column(names.index(DROP)).to_pylist(), strict=True):
            lines = text.split(b"\n")
            n_lines.append(len(lines))
            if drop:
                gone = {(d["h1"], d["h2"]) for d in drop}
                left = [x for x in lines if len(x) < min_chars or line_key(x, min_chars) not in gone]
                n_dropped.append(len(lines) - len(left))
                kept.append(b"\n".join(left))
            else:
                n_dropped.append(0)
                kept.append(text)
        columns = [batch.column(i) for i, n in enumerate(names) if n not in ("text", DROP)]
        own = [n for n in names if n not in ("text", DROP)]
        text = pa.array(kept, pa.binary()).cast(pa.string())
        yield pa.record_batch([*columns, text, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], [*own, "text", "n_lines", "n_dropped"])


class _Active:
    """The active keys, sorted, with their keepers."""

    def __init__(self, h1: np.ndarray, h2: np.ndarray, keeper: np.ndarray):
        order = np.lexsort((h2, h1))
        self.h1, self.h2, self.keeper = h1[order], h2[order], keeper[order]

    def dropped(self, h1: np.ndarray, h2: np.ndarray, doc: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Whether a line of this key goes from this document; known is false for a null doc_id."""
        at = np.searchsorted(self.h1, h1)
        held, keeper = np.zeros(len(h1), bool), np.zeros(len(h1), np.int64)
        open_ = np.arange(len(h1))
        while len(open_):  # once, but for keys that share their first half
            open_ = open_[at[open_] < len(self.h1)]
            open_ = open_[self.h1[at[open_]] == h1[open_]]
            same = self.h2[at[open_]] == h2[open_]
            held[open_[same]] = True
            keeper[open_[same]] = self.keeper[at[open_[same]]]
            open_ = open_[~same]
            at[open_] += 1
        return held & (~known | (doc != keeper))


def _drop_batches(batches: Iterator[pa.RecordBatch], min_chars: int, filters, active) -> Iterator[pa.RecordBatch]:
    """Each document without the lines that it loses: filters first, then the exact keys."""
    for batch in batches:
        names = batch.schema.names
        split = [t.split(b"\n") for t in text_bytes(batch.column(names.index("text")))]
        rows, places, h1, h2 = [], [], [], []
        for row, lines in enumerate(split):
            for place, line in enumerate(lines):
                if len(line) >= min_chars and (key := line_key(line, min_chars)):
                    rows.append(row)
                    places.append(place)
                    h1.append(key[0])
                    h2.append(key[1])
        keys = pa.record_batch([pa.array(h1, pa.int64()), pa.array(h2, pa.int64())], ["h1", "h2"])
        some = np.flatnonzero(_passes(keys, filters.value))
        ids = batch.column(names.index("doc_id")).cast(pa.int64())
        of = np.array(rows, np.int64)[some]
        doc, known = ids.fill_null(0).to_numpy()[of], ids.is_valid().to_numpy(zero_copy_only=False)[of]
        gone = some[active.value.dropped(np.array(h1, np.int64)[some], np.array(h2, np.int64)[some], doc, known)]
        n_dropped = [0] * len(split)
        for i in gone.tolist():
            split[rows[i]][places[i]] = None
            n_dropped[rows[i]] += 1
        n_lines = [len(lines) for lines in split]
        kept = [b"\n".join([x for x in lines if x is not None]) for lines in split]
        columns = [batch.column(i) for i, n in enumerate(names) if n != "text"]
        text = pa.array(kept, pa.binary()).cast(pa.string())
        yield pa.record_batch([*columns, text, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], [*(n for n in names if n != "text"), "text", "n_lines", "n_dropped"])


def apply_index(docs: DataFrame, index: LineIndex, **options) -> DataFrame:
    """docs (doc_id, text and any others) with kept text, n_lines and n_dropped, which replace columns of these names."""
    docs = docs.drop("n_lines", "n_dropped")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name != "text"]
    schema, min_chars = ", ".join([*fields, "text string", "n_lines long", "n_dropped long"]), index.min_chars
    if (held := index.broadcast(options.get("max_filter_bytes", MAX_FILTER_BYTES))) is not None:
        rows = docs.withColumn("text", F.col("text").cast("string"))
        return map_batches(rows, lambda b: _drop_batches(b, min_chars, *held), schema)
    drops = index.dropped(docs, **options).withColumnsRenamed({"doc_id": OF_DOC, "drop": DROP})
    rows = docs.join(drops, docs["doc_id"].eqNullSafe(drops[OF_DOC]), "left").drop(OF_DOC)
    return map_batches(rows, lambda b: _apply_batches(b, min_chars), schema)


def dedup_lines(docs: DataFrame, **options) -> DataFrame:
    """Inserts all documents in a new index and applies it to them."""
    return apply_index(docs, LineIndex(docs.sparkSession).insert(docs), **options)


def line_digests(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_lines, n_dropped and the SHA-256 of the kept text."""
    rows = dedup_lines(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), **options)
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
