"""Substring dedup: recurring phrases are confirmed, compiled to sharded Aho-Corasick automata, and located in all documents."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.llm.common import saved, table

WINDOW_WORDS = 20
# Each window is represented by one phrase of this many words inside it, the one of least hash. Equal windows have equal
# phrases, so only windows whose phrase recurs can recur.
PHRASE_WORDS = 8
# Documents are dealt to shards of about this many bytes of text; each has an automaton of its own.
SHARD_BYTES = 4 << 20
_PIECE = 1 << 19
_STEP = np.uint64(0xD6E8FEB86659FD93)
_OTHER = np.uint64(0xA0761D6478BD642F)
_MOST = np.uint64(0xFFFFFFFFFFFFFFFF)
_NO_ID = (1 << 63) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _STEP
    x = (x ^ (x >> np.uint64(29))) * _OTHER
    return x ^ (x >> np.uint64(32))


def pieces(text: bytes) -> Iterator[bytes]:
    """A text cut at white space into pieces of bounded size; a longer word stays whole."""
    at, n = 0, len(text)
    while n - at > _PIECE:
        end = at + _PIECE
        while end < n and not (text[end] == 32 or 9 <= text[end] <= 13):
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


class Numbers(dict):
    """Numbers keys in the order they are first asked for."""

    def __missing__(self, key: bytes) -> int:
        self[key] = number = len(self)
        return number


def word_numbers(texts: list[bytes]) -> tuple[list[np.ndarray], list[bytes]]:
    """Each text as numbers of its words, equal for equal words only, and the different words in order of their numbers."""
    known = Numbers()
    rows = []
    for text in texts:
        parts = [np.array(list(map(known.__getitem__, piece.split())), np.int32) for piece in pieces(text)]
        rows.append(np.concatenate(parts))
    return rows, list(known)


def grams(words: np.ndarray, k: int, step: np.uint64 = _STEP) -> np.ndarray:
    """A hash of the ``k`` words that start at each place."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    row = words[:n].copy()
    for j in range(1, k):
        row *= step
        row += words[j : n + j]
    return _mix(row)


def rolling(row: np.ndarray, width: int, pick=np.minimum) -> np.ndarray:
    """The least (or largest) of each ``width`` neighbours."""
    have = 1
    while have * 2 <= width:
        row = pick(row[:-have], row[have:])
        have *= 2
    return pick(row[: len(row) - (width - have)], row[width - have :]) if width > have else row


class Shard:
    """The words of some texts in one row, their phrases, and which windows lie within one text."""

    def __init__(self, texts: list[bytes], window: int = WINDOW_WORDS, phrase: int = PHRASE_WORDS):
        rows, self.known = word_numbers(texts)
        self.window, self.phrase = window, phrase
        self.words = np.concatenate([*rows, np.zeros(0, np.int32)])
        sizes = np.array([len(r) for r in rows], np.int64)
        self.first = np.r_[0, np.cumsum(sizes)][:-1].astype(np.int64)
        self.text = np.repeat(np.arange(len(texts)), sizes)
        n = len(self.words) - window + 1
        self.empty = n <= 0
        if self.empty:
            return
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.known), np.uint64, len(self.known))
        self.phrases = grams(hashes[self.words], phrase)
        self.inside = self.text[:n] == self.text[window - 1 :]
        self.least = rolling(self.phrases, window - phrase + 1)

    def chosen(self) -> np.ndarray:
        """Places of phrases that represent at least one window."""
        if self.empty:
            return np.zeros(0, np.int64)
        width = self.window - self.phrase + 1
        own = np.where(self.inside, self.least, np.uint64(0))
        pad = np.zeros(width - 1, np.uint64)
        most = rolling(np.concatenate([pad, own, pad]), width, np.maximum)
        return np.flatnonzero((most == self.phrases) & (most > 0))

    def located(self, confirmed: np.ndarray) -> np.ndarray:
        """Windows whose representing phrase is a confirmed one, by the hits of the automaton.

        ``confirmed`` are hashes of phrases that recur somewhere and represent a window of this shard. Their words are
        compiled to an automaton over one symbol a word, and all texts of the shard are streamed through it: a hit
        is a place where exactly these words stand.
        """
        if self.empty or not len(confirmed):
            return np.zeros(0, np.int64)
        line, width = symbols(self.words, len(self.known))
        span = self.phrase * width
        own = np.flatnonzero(np.isin(self.phrases, confirmed))
        own = own[np.unique(self.phrases[own], return_index=True)[1]]
        automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for p in (own * width).tolist():
            automaton.add_word(line[p : p + span])
        if not len(automaton):
            return np.zeros(0, np.int64)
        automaton.make_automaton()
        ends = np.fromiter((end for end, _ in automaton.iter(line)), np.int64)
        starts = ends - span + 1
        starts = starts[starts % width == 0] // width
        hit = np.full(len(self.phrases), _MOST)
        hit[starts] = self.phrases[starts]
        return np.flatnonzero(self.inside & (rolling(hit, self.window - self.phrase + 1) == self.least))

    def window_digests(self, windows: np.ndarray) -> np.ndarray:
        """128 bits, in two longs, of the words of each window: a digest of its words' digests."""
        out = np.zeros((len(windows), 2), np.int64)
        covered = np.zeros(len(self.words) + 1, np.int32)
        np.add.at(covered, windows, 1)
        np.add.at(covered, windows + self.window, -1)
        used = np.unique(self.words[np.cumsum(covered[:-1]) > 0])
        digests = np.zeros((len(self.known), 2), np.uint64)
        words = b"".join([blake2b(self.known[k], digest_size=16).digest() for k in used.tolist()])
        digests[used] = np.frombuffer(words, np.uint64).reshape(-1, 2)
        for at in range(0, len(windows), 1 << 14):
            own = windows[at : at + (1 << 14)]
            wide = digests[self.words[own[:, None] + np.arange(self.window)]].tobytes()
            size = 16 * self.window
            found = b"".join(blake2b(wide[k : k + size], digest_size=16).digest() for k in range(0, len(wide), size))
            out[at : at + len(own)] = np.frombuffer(found, np.int64).reshape(-1, 2)
        return out


def symbols(words: np.ndarray, different: int) -> tuple[str, int]:
    """Word numbers as a text of equally many characters for each word, and how many.

    The characters are 64 different ones: a node of the automaton looks through its children one by one, so an
    alphabet of whole words would make its root slow.
    """
    width = 1
    while 64**width < different:
        width += 1
    digits = np.stack([(words >> (6 * k)) & 63 for k in range(width)], axis=1) + 48
    return digits.astype(np.uint8).tobytes().decode("ascii"), width


def _cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches (.., text) cut to about ``SHARD_BYTES`` of text; a longer text comes by itself."""
    for batch in batches:
        lengths = np.array([len(x.as_buffer()) if x.is_valid else 0 for x in batch.column("text").cast(pa.binary())], np.int64)
        at = 0
        while at < batch.num_rows:
            take = max(1, int(np.searchsorted(np.cumsum(lengths[at:]), SHARD_BYTES, side="right")))
            yield batch.slice(at, take)
            at += take


def _texts(column) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def phrase_shards(rows: DataFrame, window: int = WINDOW_WORDS, phrase: int = PHRASE_WORDS, counts: bool = False) -> DataFrame:
    """(h, shard): hash of every phrase that represents windows of a document, and the document's shard; or (h, n) with ``counts``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _cuts(batches):
            cut = Shard(_texts(batch.column("text")), window, phrase)
            chosen = cut.chosen()
            if not len(chosen):
                continue
            h = cut.phrases[chosen].view(np.int64)
            if counts:
                h, n = np.unique(h, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n)], names=["h", "n"])
            else:
                both = np.unique(np.stack([h, batch.column("shard").to_numpy().astype(np.int64)[cut.text[chosen]]], axis=1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].astype(np.int32))], names=["h", "shard"])

    return rows.select("shard", "text").mapInArrow(work, "h long, n long" if counts else "h long, shard int")


_REPEAT = "shard int, key long, rid long, at int, length int, w long, v long"


def shard_windows(docs: pa.Table, side: pa.Table, window: int = WINDOW_WORDS, phrase: int = PHRASE_WORDS) -> pa.Table:
    """Windows of one shard's documents (shard, key, rid, text) that may recur, as rows of ``_REPEAT``.

    ``side`` has the confirmed phrases of the shard (h) and, without h, the documents (key, rid) that are whole copies of an
    earlier one. Of equal windows in a shard all but the earliest are known to be repeats, and so are all that are located
    in copies: they are given as runs, with a length and no v. The others have length 0 and the digest of
    their words, w and v, so a window that very many documents share leaves each shard once.
    """
    number = docs.column("shard")[0].as_py() if docs.num_rows else 0
    key, rid = docs.column("key").to_numpy(), docs.column("rid").to_numpy()
    one = np.unique(np.stack([key, rid], axis=1), axis=0, return_index=True)[1] if docs.num_rows else np.zeros(0, np.int64)
    key, rid = key[one], rid[one]  # rows that repeat id and text are one document
    shard = Shard(_texts(docs.column("text").take(pa.array(one))), window, phrase)
    confirmed = side.column("h").drop_null().to_numpy().view(np.uint64)
    found = shard.located(np.unique(confirmed))
    if not len(found):
        return _rows(number, *[np.zeros(0, np.int64)] * 4, None)
    copies = side.filter(side.column("h").is_null())
    copied = set(zip(copies.column("key").to_pylist(), copies.column("rid").to_pylist(), strict=True))
    copy = np.array([k in copied for k in zip(key.tolist(), rid.tolist(), strict=True)], bool)
    text = shard.text[found]
    later = copy[text]
    own = np.flatnonzero(~later)
    digests = shard.window_digests(found[own])
    at = found - shard.first[text]
    order = np.lexsort((at[own], rid[text[own]], key[text[own]], digests[:, 1], digests[:, 0]))
    digests, own = digests[order], own[order]
    heads = np.r_[True, (digests[1:] != digests[:-1]).any(axis=1)][: len(own)]
    later[own[~heads]] = True
    head = own[heads]
    out = [_rows(number, key[text[head]], rid[text[head]], at[head], np.zeros(len(head), np.int64), digests[heads])]
    if later.any():
        t, a = text[later], at[later]  # in order of text and place
        cut = np.flatnonzero(np.r_[True, (t[1:] != t[:-1]) | (a[1:] > a[:-1] + 1)])
        stop = np.r_[cut[1:], len(a)] - 1
        out.append(_rows(number, key[t[cut]], rid[t[cut]], a[cut], a[stop] - a[cut] + 1, None))
    return pa.concat_tables(out)


def _rows(shard: int, key, rid, at, length, digests) -> pa.Table:
    n = len(key)
    if digests is None:  # runs are spread by their place
        w = _mix(key.astype(np.uint64) * _STEP + rid.astype(np.uint64) + at.astype(np.uint64)).view(np.int64)
    else:
        w = digests[:, 0]
    columns = {
        "shard": pa.array(np.full(n, shard, np.int32)), "key": pa.array(key), "rid": pa.array(rid), "at": pa.array(at.astype(np.int32)),
        "length": pa.array(length.astype(np.int32)), "w": pa.array(np.ascontiguousarray(w)),
        "v": pa.nulls(n, pa.int64()) if digests is None else pa.array(np.ascontiguousarray(digests[:, 1])),
    }
    return pa.table(columns)


_KEPT = "doc_id long, n_words long, n_removed long, spans array<struct<start: long, end: long>>, kept_text string"


def without_repeats(docs: pa.Table, repeats: pa.Table, window: int = WINDOW_WORDS) -> pa.Table:
    """Rows of ``_KEPT`` for one shard's documents, given where their repeated windows start (key, rid, at, length)."""
    starts: dict[tuple[int, int], list[tuple[int, int]]] = {}
    columns = [repeats.column(c).to_pylist() for c in ("key", "rid", "at", "length")]
    for key, rid, at, length in zip(*columns, strict=True):
        starts.setdefault((key, rid), []).append((at, at + max(length, 1) + window - 1))
    counts, removed, spans, kept = [], [], [], []
    for key, rid, text in zip(docs.column("key").to_pylist(), docs.column("rid").to_pylist(), _texts(docs.column("text")), strict=True):
        words = text.split()
        runs = []
        for start, end in sorted(starts.get((key, rid), ())):
            if runs and start <= runs[-1][1]:
                runs[-1][1] = max(runs[-1][1], end)
            else:
                runs.append([start, end])
        rest, at = [], 0
        for start, end in runs:
            rest += words[at:start]
            at = end
        rest += words[at:]
        counts.append(len(words))
        removed.append(len(words) - len(rest))
        spans.append([{"start": start, "end": end} for start, end in runs])
        kept.append(b" ".join(rest))
    kinds = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    ids = [None if key == _NO_ID else key for key in docs.column("key").to_pylist()]
    columns = [pa.array(ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, kinds), pa.array(kept, pa.binary()).cast(pa.string())]
    return pa.table(columns, names=["doc_id", "n_words", "n_removed", "spans", "kept_text"])


def drop_repeats(docs: DataFrame, window: int = WINDOW_WORDS, phrase: int = PHRASE_WORDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, spans (start and end, in words, removed), kept_text.

    A window of ``window`` words is a repeat if its words also start earlier, in a document of smaller id or earlier in
    the same one; all words of repeats go, judged on the input. The steps:

    1. Every text gives its representing phrases; those counted at least twice are confirmed. Map tasks pre-sum.
    2. Documents are dealt to shards of bounded size by a hash. A shard learns which of its phrases are confirmed, not where
       they stand (a join on the phrase whose large side may be split).
    3. Each shard compiles these phrases to an Aho-Corasick automaton and streams all its documents through it. The hits
       are the only source of places. So every document is streamed once, and the automata grow with a
       shard and not with the corpus.
    4. Windows around hits are compared over all documents by 128 bits of a digest of their words; a shard sends each once.
    5. Repeats meet their documents in the shard again, by the same exchange of texts as in step 3.

    Inside a shard words are compared as they are, and between shards windows by a cryptographic digest of digests of
    their words. Whole copies of a text, known by SHA-256, are streamed like other documents, but their windows, which
    all start earlier in the first one, need no comparing in step 4.

    Null text is empty and has no words. A document of fewer words than a window keeps all. Rows that repeat id and text are
    one document. Rows that repeat an id with another text are documents of their own, each judged by its own text, in order of
    their texts' SHA-256. A null id counts as the largest. An empty table gives an empty result; other columns are ignored.
    """
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(key.alias("key"), text.alias("text"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    shards = max(-(-total // SHARD_BYTES), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    digest = F.sha2("text", 256)
    rows = rows.withColumn("rid", F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("key", "rid"), F.lit(shards)).cast("int"))
    narrow = rows.select("key", "rid", "shard", digest.alias("digest"))
    firsts = narrow.groupBy("digest").agg(F.min("key").alias("first"), F.max("key").alias("last")).where("first < last")
    copies = narrow.join(firsts.withColumnRenamed("digest", "_digest"), F.col("digest") == F.col("_digest")).where("key > first")
    # stored, so that the join below reads both sides from plain exchanges and its hot partitions can be split
    confirmed = phrase_shards(rows, window, phrase, counts=True).groupBy("h").agg(F.sum("n").alias("n")).where("n > 1")
    confirmed = saved(confirmed.select(F.col("h").alias("_h")))
    phrases = phrase_shards(rows, window, phrase).join(confirmed, F.col("h") == F.col("_h"), "left_semi")
    none = F.lit(None).cast("long")
    side = phrases.select("shard", "h", none.alias("key"), none.alias("rid")).unionByName(copies.select("shard", none.alias("h"), "key", "rid"))
    # both uses of the texts take the same columns, so that they are one exchange
    texts = rows.select("shard", "key", "rid", "text").groupBy("shard")
    windows = texts.cogroup(side.groupBy("shard")).applyInArrow(lambda a, b: shard_windows(a, b, window, phrase), _REPEAT)
    first = Window.partitionBy("w", "v").orderBy("key", "rid", "at")
    repeats = windows.withColumn("rank", F.row_number().over(first)).where((F.col("length") > 0) | (F.col("rank") > 1))
    repeats = repeats.select("shard", "key", "rid", "at", "length").groupBy("shard")
    return texts.cogroup(repeats).applyInArrow(lambda a, b: without_repeats(a, b, window), _KEPT)


def op1_repeats(spark, sf_dir: str) -> DataFrame:
    found = drop_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH texts AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), words AS (
    SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM texts
), windows AS (
    SELECT doc_id, start, array_to_string(words[start:start + 19], ' ') AS passage
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS start FROM texts WHERE len(words) >= 20)
), repeats AS (
    SELECT doc_id, start FROM windows
    QUALIFY row_number() OVER (PARTITION BY passage ORDER BY doc_id, start) > 1
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(start, start + 20)) AS place FROM repeats
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
)
SELECT t.doc_id, len(t.words) AS n_words, len(t.words) - coalesce(k.n, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k ON t.doc_id = k.doc_id
"""
