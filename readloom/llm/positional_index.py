"""A positional inverted index of the training texts, and benchmark phrases looked up in it.

The index is a staged table of segments, each over about 8 MB of text: its terms (hashes of
words, sorted), where each term's postings begin, and the postings, word places in the
segment as differences. A segment answers alone, so nothing of the corpus is shuffled.
A phrase is found by intersecting the postings of its terms, each shifted by the term's
offset, from the term that is rarest in the whole corpus on. With slop the terms need not
stand at their places, but at most so many words from them (a proximity match).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, Words, batch, block_slices, slices, staged

WINDOW = 13
#: Words that a term may lie away from its place in a proximity match.
SLOP = 2
SEGMENT_BYTES = 8 << 20
#: Bytes of benchmark text that are looked up, and broadcast, at once; more takes another pass over the index.
#: Some 350,000 phrases, for which driver and workers need about 300 MB.
QUERY_BYTES = 2 << 20

_SEGMENT = pa.schema([("segment_id", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_words", pa.list_(pa.int64())), ("terms", pa.binary()), ("begins", pa.binary()), ("postings", pa.binary())])
_HITS = pa.schema([("segment_id", pa.int64()), ("row", pa.int32()), ("doc_id", pa.int64()), ("items", pa.list_(pa.string())), ("hits", pa.list_(pa.int32())), ("near", pa.list_(pa.string()))])


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The segments of all whole texts (null: no words), a row each, as a staged table."""

    def work(batches):
        from pyspark import TaskContext

        number, ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0
        for rows, raw in slices(batches):
            ids += rows.column("doc_id").to_pylist()
            texts += raw
            size += sum(map(len, raw))
            if size >= SEGMENT_BYTES or len(ids) >= 50_000:
                yield segment(number, ids, texts)
                number, ids, texts, size = number + 1, [], [], 0
        if ids:
            yield segment(number, ids, texts)

    def segment(number, ids, texts):
        words = [Words(part, WORD, lower=True) for _, part in block_slices(texts)]
        h = np.concatenate([w.hashes() for w in words])
        order = np.argsort(h, kind="stable")
        h = h[order]
        begins = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.empty(0, np.int64)
        steps = np.diff(order.astype(np.uint32), prepend=np.uint32(0))
        return batch(_SEGMENT, [number], [ids], [np.concatenate([w.counts for w in words])], [h[begins].tobytes()], [np.append(begins, len(h)).astype("<u4").tobytes()], [steps.astype("<u4").tobytes()])

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return staged(rows.mapInArrow(work, "segment_id long, doc_ids array<long>, n_words array<long>, terms binary, begins binary, postings binary"), "segments")


def term_counts(index: DataFrame, terms: np.ndarray) -> np.ndarray:
    """How often each of some sorted terms occurs in the whole corpus. Reads no postings."""
    spark = index.sparkSession
    wanted = spark.sparkContext.broadcast(terms)
    schema = pa.schema([("term", pa.int64()), ("n", pa.int64())])

    def work(batches):
        for rows in batches:
            for k, b in zip(rows.column("terms").to_pylist(), rows.column("begins").to_pylist(), strict=True):
                k, n = np.frombuffer(k, np.uint64), np.diff(np.frombuffer(b, "<u4").astype(np.int64))
                _, ours, theirs = np.intersect1d(wanted.value, k, assume_unique=True, return_indices=True)
                yield batch(schema, ours, n[theirs])

    found = np.zeros(len(terms), np.int64)
    for term, n in index.select("terms", "begins").mapInArrow(work, "term long, n long").groupBy("term").agg(F.sum("n")).collect():
        found[term] = n
    return found


class Phrases:
    """Distinct phrases, as term hashes in order, with the names of the items that have them (an item without id has none)."""

    def __init__(self, items: list[tuple[str, str | None]], window: int | None):
        w = Words([(t or "").encode() for _, t in items], WORD, lower=True)
        h, found = w.hashes(), {}
        for k, (name, _) in enumerate(items):
            own = h[w.first[k] : w.first[k + 1]]
            n = min(window or len(own), len(own))
            for i in range(len(own) - n + 1 if n else 0):
                found.setdefault(own[i : i + n].tobytes(), set()).update([] if name is None else [name])
        self.terms = [np.frombuffer(k, np.uint64) for k in found]
        self.items = [sorted(v) for v in found.values()]
        self.vocabulary = np.unique(np.concatenate(self.terms)) if found else np.empty(0, np.uint64)
        self.size = np.array([len(t) for t in self.terms], np.int64)
        #: all phrases' terms as places in the vocabulary, one phrase after the other, and where each begins
        self.flat = np.searchsorted(self.vocabulary, np.concatenate(self.terms)).astype(np.int32) if found else np.empty(0, np.int32)
        self.begin = np.cumsum(self.size) - self.size
        self.terms = None

    def ids(self, k: int) -> np.ndarray:
        return self.flat[self.begin[k] : self.begin[k] + self.size[k]]

    def order_by(self, counts: np.ndarray) -> None:
        """Fix the order in which each phrase's terms are taken: rarest first, of equals the first."""
        self.order = [np.argsort(counts[self.ids(k)], kind="stable") for k in range(len(self.size))]

    def possible(self, known: np.ndarray) -> np.ndarray:
        """The phrases of which all terms are known."""
        return np.flatnonzero(np.minimum.reduceat(known[self.flat], self.begin) >= 0) if len(self.size) else np.empty(0, np.int64)


class Segment:
    """A segment's postings."""

    def __init__(self, terms: bytes, begins: bytes, postings: bytes, n_words: np.ndarray):
        self.terms, self.begins = np.frombuffer(terms, np.uint64), np.frombuffer(begins, "<u4")
        self.places = np.cumsum(np.frombuffer(postings, "<u4"), dtype=np.uint32).view(np.int32)
        self.docs_end = np.cumsum(n_words).astype(np.int32)

    def of(self, term: int) -> np.ndarray:
        return self.places[self.begins[term] : self.begins[term + 1]]

    def known(self, vocabulary: np.ndarray) -> np.ndarray:
        """For each term of a vocabulary its place in this segment, or -1."""
        if not len(self.terms):
            return np.full(len(vocabulary), -1)
        at = np.minimum(np.searchsorted(self.terms, vocabulary), len(self.terms) - 1)
        return np.where(self.terms[at] == vocabulary, at, -1)

    def find(self, ids: np.ndarray, order: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
        """Places where a phrase begins, and those from which each term lies up to slop words from its place.

        Places are counted from the first term of the order; all terms lie in its document.
        """
        first, *others = order.tolist()  # places stay 32 bits wide
        near = self.of(ids[first]) - np.int32(first)
        for k in others:
            if not len(near):
                return near, near
            near = near[self._within(near + (k - slop), near + (k + slop), ids[k])]
        docs = np.searchsorted(self.docs_end, near + first, side="right")
        low, high = np.append(np.int32(0), self.docs_end)[docs], self.docs_end[docs] - 1
        if slop:
            inside = np.ones(len(near), bool)
            for k in others:
                inside &= self._within(np.maximum(near + (k - slop), low), np.minimum(near + (k + slop), high), ids[k])
            near, low, high = near[inside], low[inside], high[inside]
        exact = (near >= low) & (near + (len(ids) - 1) <= high)
        for k in others if slop else ():
            exact &= self._within(near + k, near + k, ids[k])
        return near[exact], near if slop else near[exact]

    def _within(self, low: np.ndarray, high: np.ndarray, term: int) -> np.ndarray:
        """Which of some stretches of places have a term."""
        places = self.of(term)
        at = np.searchsorted(places, low)
        return (at < len(places)) & (places[np.minimum(at, len(places) - 1)] <= high)


def _groups(items: DataFrame, item_id: str, text: str) -> list[list[tuple[str, str | None]]]:
    """The distinct items, in groups of about QUERY_BYTES; a longer item is a group of its own."""
    items = items.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text")).where("text is not null").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // QUERY_BYTES) or 1
    for k in range(n):
        yield [(r.item, r.text) for r in items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k).collect()]


def phrase_matches(index: DataFrame, items: DataFrame, item_id: str = "item_id", text: str = "text", window: int | None = WINDOW, slop: int = 0) -> DataFrame:
    """segment_id, row, doc_id, items array<string>, hits array<int>, near array<string>: matches by document of the index.

    A phrase is `window` consecutive words of an item, or all of an item with fewer (None: all
    words of each). hits are the document's words that lie inside an exact match, items the items that
    match so. near are the items with a phrase of which each word lies at most `slop` words from its
    place, counted from the phrase's word that is rarest in the corpus (of equals the first); those
    that match are among them. Documents without a match and items without words give no row; items
    without id match but are not named; a document has a row for each group of items that it matches.
    """
    spark, found = index.sparkSession, None
    for group in _groups(items, item_id, text):
        phrases = Phrases(group, window)
        phrases.order_by(term_counts(index, phrases.vocabulary))
        shared = spark.sparkContext.broadcast(phrases)

        def work(batches, shared=shared):
            p = shared.value
            for rows in batches:
                for i in range(rows.num_rows):
                    row = {c: rows.column(c)[i].as_py() for c in ("segment_id", "terms", "begins", "postings")}
                    n_words = rows.column("n_words")[i].values.to_numpy(zero_copy_only=False).astype(np.int64)
                    yield matched(p, row, n_words, rows.column("doc_ids")[i])

        def matched(p, row, n_words, doc_ids):
            seg = Segment(row["terms"], row["begins"], row["postings"], n_words)
            known = seg.known(p.vocabulary)
            where, names, close = {}, {}, {}
            doc_start = seg.docs_end - n_words
            for k in p.possible(known):
                n, order = p.size[k], p.order[k]
                at, near = seg.find(known[p.ids(k)], order, slop)
                for d in np.unique(np.searchsorted(seg.docs_end, near + order[0], side="right")).tolist():
                    close.setdefault(d, set()).update(p.items[k])  # none, if items have no id
                docs = np.searchsorted(seg.docs_end, at, side="right")
                for d, place in zip(docs.tolist(), (at - doc_start[docs]).tolist(), strict=True):
                    where.setdefault(d, set()).update(range(place, place + n))
                    names.setdefault(d, set()).update(p.items[k])
            docs = sorted(close)
            return batch(_HITS, [row["segment_id"]] * len(docs), docs, [doc_ids[d].as_py() for d in docs], *([sorted(x.get(d, ())) for d in docs] for x in (names, where, close)))

        part = index.mapInArrow(work, "segment_id long, row int, doc_id long, items array<string>, hits array<int>, near array<string>")
        found = part if found is None else found.unionByName(part)
    return found


def proximity_matches(index: DataFrame, items: DataFrame, slop: int = SLOP, item_id: str = "item_id", text: str = "text", window: int | None = None) -> DataFrame:
    """doc_id, item: documents with a proximity match of an item, as `phrase_matches` has them; by default of all its words.

    An item counts once for a document; items without id or words give no row.
    """
    return phrase_matches(index, items, item_id, text, window, slop).select("doc_id", F.explode("near").alias("item")).distinct()


def contamination(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, slop: int = SLOP) -> DataFrame:
    """doc_id, n_words, n_hit, items and near array<string> (sorted), contaminated, for every row of `docs`.

    contaminated: some word is hit, and one word in twenty at least. near: items with a window that
    matches exactly or in proximity, each word at most `slop` words from its place. Rows are kept apart even
    if doc_ids repeat or are null; null and empty texts have no words; an empty table of items
    hits nothing. Words of items without id are hit, but such items are not among `items`; items
    of one id count as one, and an empty table of documents gives none.
    """
    index = build_index(docs, doc_id, text)

    def merged(column: str):
        return F.array_distinct(F.flatten(F.collect_list(column)))  # a row for each group of items

    hits = phrase_matches(index, items, item_id, item_text, window, slop).groupBy("segment_id", "row").agg(F.array_sort(merged("items")).alias("items"), F.array_sort(merged("near")).alias("near"), F.size(merged("hits")).cast("long").alias("n_hit"))
    rows = index.select("segment_id", F.posexplode(F.arrays_zip("doc_ids", "n_words"))).select("segment_id", F.col("pos").alias("row"), F.col("col.doc_ids").alias("doc_id"), F.col("col.n_words").alias("n_words"))
    none = F.array().cast("array<string>")
    out = rows.join(hits, ["segment_id", "row"], "left").select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", none).alias("items"), F.coalesce("near", none).alias("near"))
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words")))
