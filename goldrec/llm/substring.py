"""Substring dedup with suffix automata of reference shards.

A *window* is ``window`` consecutive words of one document.  A word goes when a
window that covers it also starts in a document with a smaller doc_id; windows
are judged on the input texts.

The reference is the corpus itself, which has no size bound, so its shards are
not broadcast whole to every task: each shard's automaton stands in the one
task that all text which can match it is sent to.

1. *Anchors.*  Of the phrase hashes inside a window the smallest is its anchor;
   equal windows have equal anchors.  Anchors of one document only match
   nothing, which leaves the passages worth sending.
2. *Pieces.*  Neighbouring windows of one anchor travel as one piece of text to
   the anchor's shard, ``MAX_RUN`` at most; the windows of a frequent anchor travel singly, by their
   own hash, so no anchor makes a large shard.  Equal pieces are one row with
   their smallest doc_id, combined by batches before the shuffle and by Spark
   after it; their places are written in the same pass.
3. *Automata.*  Shards build the suffix automaton of their pieces; a state keeps
   the smallest doc_id of its occurrences.  Streaming the pieces gives the
   matching statistics: at every word, the state of the last ``window`` words
   and thereby the smallest document holding them.
4. *Spans.*  Judged windows return to the documents, are merged to maximal
   spans and cut out.

Hashes choose candidates only; words are compared as words in the automata, and
pieces return by 128 bits of independent hashes.

``strip_reference`` is the same operator against a reference of a bounded,
checked size (a benchmark, say), whose automata are broadcast.

Defined results: a null text counts as empty (no words, the empty text's
digest); a row with null doc_id is kept whole and removes nothing; rows with one
doc_id never remove each other's words; repeated rows each return; columns other
than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrec.llm.common import Scratch, lean, release, ship

WINDOW = 13
PHRASE = 6  # words of an anchor phrase
FREQUENT = 512  # occurrences from which an anchor's windows travel singly
MAX_RUN = 256  # windows of a piece, also where a text repeats itself
SHARD_WORDS = 40_000  # words of one automaton, from whole anchors
SLICE_BYTES = 1 << 20  # text hashed at a time


class WordHasher:
    """Hashes of words and phrases of many texts at once, by prefix sums of a polynomial modulo 2^64."""

    def __init__(self) -> None:
        import numpy as np

        self.np = np
        self.base = np.uint64(0x9E3779B97F4A7C15 | 1)
        self.inverse = np.uint64(pow(int(self.base), -1, 1 << 64))
        self.space = np.zeros(256, bool)
        self.space[[9, 10, 11, 12, 13, 32]] = True
        self.grow(1 << 12)

    def grow(self, n: int) -> None:
        np = self.np
        with np.errstate(over="ignore"):
            self.powers = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, self.base, np.uint64))])
            self.inverses = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, self.inverse, np.uint64))])

    def mix(self, x):
        np = self.np
        with np.errstate(over="ignore"):
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            return x ^ (x >> np.uint64(31))

    def words(self, texts: list[bytes]):
        """(text number, hash) of every word of ``texts``, in order."""
        np = self.np
        blob = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
        if len(blob) >= len(self.powers):
            self.grow(2 * len(blob))
        sizes = np.array([len(t) + 1 for t in texts])
        ink = ~self.space[blob]
        edge = np.diff(ink.view(np.int8), prepend=np.int8(0))
        starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        with np.errstate(over="ignore"):
            sums = np.cumsum((blob.astype(np.uint64) + np.uint64(1)) * self.powers[: len(blob)], dtype=np.uint64)
            sums = np.concatenate([[np.uint64(0)], sums])
            h = (sums[stops] - sums[starts]) * self.inverses[starts]
        return np.searchsorted(np.cumsum(sizes), starts, "right"), self.mix(h)

    def phrases(self, h, k: int):
        """Hash of the k words from each place on."""
        np = self.np
        n = max(0, len(h) - k + 1)
        out = np.zeros(n, np.uint64)
        with np.errstate(over="ignore"):
            for j in range(k):
                out = out * self.base + h[j : j + n]
        return self.mix(out)

    def anchors(self, texts: list[bytes], window: int, phrase: int):
        """(text number, first word's place in the text, anchor, hash) of every window of ``texts``."""
        np = self.np
        doc, h = self.words(texts)
        n = max(0, len(h) - window + 1)
        inside = doc[:n] == doc[window - 1 : window - 1 + n]
        p = self.phrases(h, phrase)
        low = p[:n].copy()
        for j in range(1, window - phrase + 1):
            np.minimum(low, p[j : j + n], out=low)
        whole = self.phrases(h, window)
        first = np.searchsorted(doc, np.arange(len(texts)))
        at = np.flatnonzero(inside)
        return doc[at], at - first[doc[at]], low[at].view(np.int64), whole[at].view(np.int64)


def slices(batch, text_at: int, size: int = SLICE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """Cuts a batch to runs of rows with about ``size`` bytes of text: (first row, texts)."""
    first, texts, total = 0, [], 0
    for i, t in enumerate(batch.column(text_at)):
        t = (t.as_py() or "").encode()
        if texts and total + len(t) > size:
            yield first, texts
            first, texts, total = i, [], 0
        texts.append(t)
        total += len(t)
    if texts:
        yield first, texts


class Automaton:
    """Suffix automaton of word sequences; each state has the smallest tag of its occurrences."""

    def __init__(self) -> None:
        self.next: list[dict] = [{}]
        self.link, self.size, self.tag = [-1], [0], [1 << 63]

    def _state(self, size: int, link: int, moves: dict, tag: int) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.size.append(size)
        self.tag.append(tag)
        return len(self.size) - 1

    def add(self, words: list, tag: int) -> None:
        nxt, link, size, tags = self.next, self.link, self.size, self.tag
        last = 0
        for w in words:
            to = nxt[last].get(w)
            if to is not None and size[to] == size[last] + 1:
                last = to
            else:
                longer = size[last] + 1
                if to is None:
                    cur, p = self._state(longer, 0, {}, 1 << 63), last
                    while p >= 0 and w not in nxt[p]:
                        nxt[p][w] = cur
                        p = link[p]
                    q = nxt[p][w] if p >= 0 else 0
                else:
                    cur, p, q = -1, last, to
                if p >= 0 and size[q] != size[p] + 1:
                    copy = self._state(size[p] + 1, link[q], dict(nxt[q]), 1 << 63)
                    link[q] = copy
                    while p >= 0 and nxt[p].get(w) == q:
                        nxt[p][w] = copy
                        p = link[p]
                    q = copy
                if cur >= 0:
                    link[cur] = q
                    last = cur
                else:
                    last = q
            if tag < tags[last]:
                tags[last] = tag

    def settle(self) -> None:
        """Pass the tags on to the suffixes; once, after the last ``add``."""
        tags, link = self.tag, self.link
        for s in sorted(range(1, len(tags)), key=self.size.__getitem__, reverse=True):
            if tags[s] < tags[link[s]]:
                tags[link[s]] = tags[s]

    def smallest(self, words: list, window: int) -> list[int | None]:
        """For every window of ``words``: the smallest tag of a sequence that holds it, or None."""
        nxt, link, size, tags = self.next, self.link, self.size, self.tag
        out, s, length = [], 0, 0
        for i, w in enumerate(words):
            while s and w not in nxt[s]:
                s = link[s]
                length = size[s]
            to = nxt[s].get(w)
            if to is None:
                length = 0
            else:
                s, length = to, length + 1
                if length >= window:
                    while size[link[s]] >= window:
                        s = link[s]
                    length = min(length, window)
            if i >= window - 1:
                out.append(tags[s] if length >= window else None)
        return out


def _covered(places, window: int, n_words: int):
    """Which of n_words words the windows at ``places`` cover."""
    import numpy as np

    gone = np.zeros(n_words + 1, np.int64)
    places = np.unique(np.asarray(places, np.int64))
    np.add.at(gone, places, 1)
    np.add.at(gone, np.minimum(places + window, n_words), -1)
    return np.cumsum(gone)[:n_words] > 0


def _kept(words: list[bytes], gone) -> tuple[int, str]:
    kept = [w for w, g in zip(words, gone.tolist()) if not g]
    return len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()


def _spans(gone) -> list[dict]:
    import numpy as np

    edge = np.diff(gone.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    return [{"start": int(a), "end": int(b)} for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))]


SPANS = "array<struct<start:long,end:long>>"


def _anchor_rows(window: int, phrase: int):
    """(doc_id, text) -> (h, low, high, n): anchors with their documents, combined a slice at a time."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        hasher = WordHasher()
        for b in batches:
            ids = np.asarray(b.column(0))
            for first, texts in slices(b, 1):
                doc, _, anchor, _ = hasher.anchors(texts, window, phrase)
                if not len(doc):
                    continue
                new = np.ones(len(doc), bool)
                new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
                h, d = anchor[new], ids[first + doc[new]]
                order = np.lexsort((d, h))
                h, d = h[order], d[order]
                at = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
                stop = np.concatenate([at[1:], [len(h)]])
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (h[at], d[at], d[stop - 1], stop - at)], names=["h", "low", "high", "n"])

    return run


def _anchors_of(window: int, phrase: int):
    """(doc_id, text) -> (h, doc_id), each pair once a slice."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        hasher = WordHasher()
        for b in batches:
            ids = np.asarray(b.column(0))
            for first, texts in slices(b, 1):
                doc, _, anchor, _ = hasher.anchors(texts, window, phrase)
                if not len(doc):
                    continue
                order = np.lexsort((anchor, doc))
                h, d = anchor[order], doc[order]
                new = np.ones(len(d), bool)
                new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(h[new]), pa.array(ids[first + d[new]])], names=["h", "doc_id"])

    return run


PIECES = "route long, key long, doc_id long, piece string, tkey long, at int"


def _pieces(window: int, phrase: int):
    """(doc_id, tkey, text, shared, frequent) -> the pieces of the shared anchors (PIECES).

    Every piece gives its place (route, key, doc_id, tkey, at).  The first of equal
    pieces of a batch also gives the piece, with the batch's smallest doc_id.
    """

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import xxhash

        hasher = WordHasher()
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int32()]
        names = [f.split()[0] for f in PIECES.split(", ")]

        def table(n: int, **columns):
            return pa.RecordBatch.from_arrays([pa.array(columns[c], k) if c in columns else pa.nulls(n, k) for c, k in zip(names, kinds)], names=names)

        for b in batches:
            ids, tkeys = b.column(0), b.column(1)
            firsts: dict[tuple[int, int], tuple] = {}
            for first, texts in slices(b, 2):
                rows = []
                doc, place, anchor, whole = hasher.anchors(texts, window, phrase)
                bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
                for i, text in enumerate(texts):
                    a, z = bounds[i], bounds[i + 1]
                    if a == z:
                        continue
                    often = np.array(b.column(4)[first + i].as_py() or [], np.int64)
                    mine = np.array(b.column(3)[first + i].as_py() or [], np.int64)
                    words, h = text.split(), anchor[a:z]
                    wanted, single = np.isin(h, mine), np.isin(h, often)
                    new = np.ones(z - a, bool)
                    new[1:] = (h[1:] != h[:-1]) | single[1:]
                    n = np.arange(z - a)
                    new |= (n - np.maximum.accumulate(np.where(new, n, 0))) % MAX_RUN == 0
                    at = np.flatnonzero(new)
                    stop = np.concatenate([at[1:], [z - a]])
                    use = wanted[at]
                    doc_id, tkey = ids[first + i].as_py(), tkeys[first + i].as_py()
                    routes = np.where(single[at], whole[a:z][at], h[at])
                    for p, q, r in zip(at[use].tolist(), stop[use].tolist(), routes[use].tolist()):
                        piece = b" ".join(words[p : q + window - 1])
                        key = xxhash.xxh3_64_intdigest(piece) - (1 << 63)
                        rows.append((r, key, doc_id, tkey, p))
                        if (known := firsts.get((r, key))) is None or doc_id < known[0]:
                            firsts[r, key] = (doc_id, piece)
                if rows:
                    yield table(len(rows), **dict(zip(("route", "key", "doc_id", "tkey", "at"), zip(*rows))))
            items = list(firsts.items())
            for at in range(0, len(items), 10_000):
                some = items[at : at + 10_000]
                route, key = zip(*(name for name, _ in some))
                doc_id, piece = zip(*(v for _, v in some))
                yield table(len(some), route=route, key=key, doc_id=doc_id, piece=[x.decode() for x in piece])

    return run


def _judge(window: int, shard_words: int):
    """Rows (route, key, doc_id, piece), ordered by route -> (route, key, firsts): smallest doc_id of each window.

    A shard is closed between routes once it has ``shard_words`` words.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def judged(rows: list):
            auto, numbers = Automaton(), {}
            seqs = [[numbers.setdefault(w, len(numbers)) for w in piece.split(" ")] for _, _, _, piece in rows]
            for (_, _, doc, _), seq in zip(rows, seqs):
                auto.add(seq, doc)
            auto.settle()
            firsts = [auto.smallest(seq, window) for seq in seqs]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array(firsts, pa.list_(pa.int64()))],
                names=["route", "key", "firsts"],
            )

        rows, total = [], 0
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if total >= shard_words and row[0] != rows[-1][0]:
                    yield judged(rows)
                    rows, total = [], 0
                rows.append(row)
                total += row[3].count(" ") + 1
        if rows:
            yield judged(rows)

    return run


def _cut(window: int):
    """(doc_id, tkey, text, places) -> what is left of the text."""

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for pdf in batches:
            out = []
            for d, k, text, places in zip(pdf.doc_id, pdf.tkey, pdf.text, pdf.places):
                words = (text or "").encode().split()
                gone = _covered(places, window, len(words))
                out.append((d, k, *_kept(words, gone), _spans(gone)))
            yield pd.DataFrame(out, columns=["doc_id", "tkey", "cut", "cut_sha256", "cut_spans"])

    return run


def _whole(batches: Iterator) -> Iterator:
    """(doc_id, tkey, text) -> (doc_id, tkey, n_words, whole_sha256)."""
    import pyarrow as pa

    for b in batches:
        n, sha = [], []
        for t in b.column(2):
            words = (t.as_py() or "").encode().split()
            n.append(len(words))
            sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(sha)], names=["doc_id", "tkey", "n_words", "whole_sha256"])


def dedup_substrings(docs: DataFrame, window: int = WINDOW, phrase: int = PHRASE, frequent: int = FREQUENT, shard_words: int = SHARD_WORDS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, removed_spans) for every row; spans count words, end exclusive."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = docs.where("doc_id is not null and text is not null")

    anchors = known.mapInArrow(lean(_anchor_rows(window, phrase)), "h long, low long, high long, n long")
    anchors = anchors.groupBy("h").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
    shared = scratch.save(anchors.where("low < high").select("h", (F.col("n") > frequent).alias("often")), "anchors")
    release(spark)

    mine = known.mapInArrow(lean(_anchors_of(window, phrase)), "h long, doc_id long").join(shared, "h")
    mine = mine.groupBy("doc_id").agg(F.collect_set("h").alias("shared"), F.collect_set(F.when(F.col("often"), F.col("h"))).alias("frequent"))
    keyed = known.select("doc_id", F.xxhash64("text").alias("tkey"), "text")
    passages = scratch.save(keyed.join(mine, "doc_id"), "passages")
    release(spark)

    pieces = scratch.save(passages.mapInArrow(lean(_pieces(window, phrase)), PIECES), "pieces")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    alike = pieces.where("piece is not null").select("route", "key", "doc_id", "piece").repartition(parts, "route")
    alike = alike.groupBy("route", "key").agg(F.min("doc_id").alias("doc_id"), F.first("piece").alias("piece"))
    shards = alike.sortWithinPartitions("route", "key")
    judged = scratch.save(shards.mapInArrow(lean(_judge(window, shard_words)), "route long, key long, firsts array<long>"), "judged")
    release(spark)

    places = pieces.where("piece is null").select("route", "key", "doc_id", "tkey", "at")
    places = places.join(judged.where(F.exists("firsts", lambda f: f.isNotNull())), ["route", "key"])
    places = places.where(F.exists("firsts", lambda f: f < F.col("doc_id")))
    marks = F.filter(F.transform("firsts", lambda f, i: F.when(f < F.col("doc_id"), F.col("at") + i)), lambda x: x.isNotNull())
    places = places.select("doc_id", "tkey", marks.alias("marks")).groupBy("doc_id", "tkey").agg(F.flatten(F.collect_list("marks")).alias("places"))
    cut = passages.select("doc_id", "tkey", "text").join(places, ["doc_id", "tkey"])
    cut = cut.mapInPandas(lean(_cut(window)), f"doc_id long, tkey long, cut long, cut_sha256 string, cut_spans {SPANS}")
    cut = scratch.save(cut.dropDuplicates(["doc_id", "tkey"]), "cut")
    for done in ("pieces", "judged", "passages", "anchors"):
        scratch.remove(done)
    release(spark)

    whole = docs.select("doc_id", F.xxhash64("text").alias("tkey"), "text").mapInArrow(lean(_whole), "doc_id long, tkey long, n_words long, whole_sha256 string")
    return whole.join(cut, ["doc_id", "tkey"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("cut", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("cut_sha256", "whole_sha256").alias("kept_sha256"),
        F.coalesce("cut_spans", F.array().cast(SPANS)).alias("removed_spans"),
    )


def strip_reference(docs: DataFrame, reference: DataFrame, window: int = WINDOW, max_reference_bytes: int = 8 << 20, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Cut every passage of ``window`` or more words that ``reference`` (column text) holds too.

    The reference's size is measured first; beyond ``max_reference_bytes`` it is
    refused (``dedup_substrings`` over the union has no such bound).  Its shards'
    automata are built once and broadcast, and documents stream past them.
    Returns (doc_id, n_words, n_removed, kept_text) for every row.
    """
    spark = docs.sparkSession
    size = reference.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > max_reference_bytes:
        raise ValueError(f"the reference has {size} bytes, more than max_reference_bytes ({max_reference_bytes})")
    shards, auto, total = [], Automaton(), 0
    for (text,) in reference.where("text is not null").select("text").toLocalIterator():
        words = text.encode().split()
        if total and total + len(words) > shard_words:
            auto.settle()
            shards.append((auto.next, auto.link, auto.size, auto.tag))
            auto, total = Automaton(), 0
        auto.add(words, 0)
        total += len(words)
    auto.settle()
    shards.append((auto.next, auto.link, auto.size, auto.tag))
    sent = spark.sparkContext.broadcast(shards)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        autos = []
        for parts in sent.value:
            a = Automaton()
            a.next, a.link, a.size, a.tag = parts
            autos.append(a)
        for pdf in batches:
            out = []
            for d, text in zip(pdf.doc_id, pdf.text):
                words = (text or "").encode().split()
                hits = [i for a in autos for i, t in enumerate(a.smallest(words, window)) if t is not None]
                gone = _covered(hits, window, len(words)) if hits else np.zeros(len(words), bool)
                kept = [w for w, g in zip(words, gone.tolist()) if not g]
                out.append((d, len(words), len(words) - len(kept), b" ".join(kept).decode()))
            yield pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept_text"])

    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, n_removed long, kept_text string")


ship(__name__)
