"""Evaluation texts that leaked into training text.

Latent semantic retrieval. Texts become sequences of word codes, blind to case, punctuation, markup,
spacing, accents, invisible and look-alike characters. All passages of the corpus, in TF-IDF weights, give a
randomised range finder: each partition sums A'(A W) of its passages for one seeded random W, the sums are
added over the partitions, and a Nystrom step turns them into the leading right singular vectors. Overlapping
windows of documents and items are projected onto these, and windows whose cosine passes a threshold are
candidates. Each candidate pair is then aligned exactly: the longest common run of words in order that allows
single replaced words, at most one in ten, and must reach forty words.

The items are the stated query set: a table of fixed size, sent to each task. Documents stay where they are.

Defined results: null and blank texts, and items shorter than forty words, match nothing. A document is
reported once per item however often it quotes it. Repeated rows with one doc_id are one document.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.runtime import Scratch

BUCKETS = 1 << 16
RANK = 48
OVERSAMPLE = 8
SPAN = 40  # words of a window, and the least words of a leak
STEP = 10
REPLACED = 10  # one replaced word in so many
GRAMS = 20  # 38 threes of 40 words, less at most 3 for each of the 4 replaced, with room for compounds that differ

# Letters of other scripts that look like Latin ones.
LOOKALIKE = str.maketrans(
    "абвгеѕіјкмнорсԛтухһԁԝӏАВЕЅІЈКМНОРСТУХԚԜαβεικμνορτυχωΑΒΕΖΗΙΚΜΝΟΡΤΥΧıɡⅼ",
    "abbresijkmhopcqtyxhdwlabesijkmhopctyxqwabeikmvoptuxwabezhikmnoptyxigl",
)
_TAG = re.compile(r"</?[a-zA-Z!][^<>]*>|&nbsp;|&#160;")
_MARKS = re.compile("[\u0300-\u036f\u00ad\u200b-\u200f\u2060-\u2064\ufeff]")
_FOREIGN = re.compile("[\u0131\u0261\u0370-\u052f\u217c]")
_WORD = re.compile(r"[a-z0-9]+")


class _Codes(dict):
    """Codes of words as they are met. Bounded, for it lives with the worker."""

    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        c = self[word] = zlib.crc32(word.encode())
        return c


_CODES = _Codes()


def words(text: str) -> list[str]:
    """The words of a text, folded."""
    if "<" in text or "&" in text:
        text = _TAG.sub(" ", text)
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFKD", text))
        if _FOREIGN.search(text):
            text = text.translate(LOOKALIKE)
        text = text.casefold()
    return _WORD.findall(text.lower())


def weights(text: str) -> np.ndarray:
    """For each word of a text 1, but 0 for the parts of a compound or contraction after its first."""
    spaced = _TAG.sub(" ", text)
    return np.array([int(k == 0) for chunk in re.split(r"[\s–—]+", spaced) for k, _ in enumerate(words(chunk))], dtype=np.int64)


def codes(text: str) -> np.ndarray:
    """A 32-bit code for each word."""
    return np.array(list(map(_CODES.__getitem__, words(text))), dtype=np.uint32)


def encode(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, seq): the word codes of each text, as bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"id": pdf["id"], "seq": [codes(t).tobytes() for t in pdf["t"]]})

    rows = docs.filter(F.col(key).isNotNull() & F.col(text).isNotNull()).select(F.col(key).alias("id"), F.col(text).alias("t"))
    return rows.mapInPandas(run, "id bigint, seq binary")


def _sequences(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """All codes of a batch in one array, and where each text begins and ends."""
    arrays = [np.frombuffer(b, dtype=np.uint32) for b in pdf["seq"]]
    bounds = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int64) if arrays else np.zeros(1, np.int64)
    return (np.concatenate(arrays) if arrays else np.zeros(0, np.uint32)), bounds


def document_frequency(seqs: DataFrame) -> np.ndarray:
    """Texts per bucket of word codes; an array of BUCKETS numbers, whatever the corpus."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        df = np.zeros(BUCKETS, np.int64)
        for pdf in batches:
            for b in pdf["seq"]:
                df[np.unique(np.frombuffer(b, dtype=np.uint32) % BUCKETS)] += 1
        at = np.flatnonzero(df)
        yield pd.DataFrame({"b": at.astype(np.int32), "n": df[at]})

    out = np.zeros(BUCKETS, np.float64)
    for r in seqs.select("seq").mapInPandas(run, "b int, n bigint").groupBy("b").agg(F.sum("n").alias("n")).collect():
        out[r.b] = r.n
    return out


def _blocks(bounds: np.ndarray, size: int) -> np.ndarray:
    """Starts of consecutive blocks of `size` words within each text."""
    parts = [np.arange(a, b, size, dtype=np.int64) for a, b in zip(bounds[:-1], bounds[1:], strict=True) if b > a]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


def basis(seqs: DataFrame, idf: np.ndarray, seed: int = 7) -> np.ndarray:
    """BUCKETS x RANK: right singular vectors of the corpus' passages, from one pass of A'(A W)."""
    k = RANK + OVERSAMPLE
    spark = seqs.sparkSession
    shared = spark.sparkContext.broadcast(idf.astype(np.float32))  # BUCKETS numbers

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = np.random.default_rng(seed).standard_normal((BUCKETS, k), dtype=np.float32)
        weight = shared.value
        total = np.zeros((BUCKETS, k), np.float32)
        touched = np.zeros(BUCKETS, bool)
        for pdf in batches:
            seq, bounds = _sequences(pdf)
            for a, z, s in _pieces(_blocks(bounds, SPAN), len(seq), 512):
                # the passages of a block as a dense matrix over the block's own words
                b, col = np.unique(seq[a:z] % BUCKETS, return_inverse=True)
                row = np.repeat(np.arange(len(s)), np.diff(np.append(s, z)))
                m = np.bincount(row * len(b) + col, weights=weight[b][col], minlength=len(s) * len(b)).astype(np.float32).reshape(len(s), len(b))
                m /= np.sqrt(np.einsum("ij,ij->i", m, m))[:, None] + 1e-9
                total[b] += m.T @ (m @ w[b])
                touched[b] = True
        at = np.flatnonzero(touched)
        yield pd.DataFrame({"b": at.astype(np.int32), "y": [x.tobytes() for x in total[at]]})

    # one row per bucket and partition, summed by bucket
    part = seqs.select("seq").mapInPandas(run, "b int, y binary")

    def add_many(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for pdf in batches:
            for b, y in zip(pdf["b"], pdf["y"], strict=True):
                v = np.frombuffer(y, np.float32).astype(np.float64)
                sums[b] = sums[b] + v if b in sums else v
        yield pd.DataFrame({"b": np.array(list(sums), np.int32), "y": [v.astype(np.float32).tobytes() for v in sums.values()]})

    y = np.zeros((BUCKETS, k))
    for r in part.repartition("b").mapInPandas(add_many, "b int, y binary").collect():
        y[r.b] = np.frombuffer(r.y, np.float32)
    shared.unpersist()
    w = np.random.default_rng(seed).standard_normal((BUCKETS, k), dtype=np.float32).astype(np.float64)
    # Nystrom: G = A'A is near Y (W'Y)^-1 Y'; its eigenvectors come from the Cholesky-like factor Y C^-1/2
    c = w.T @ y
    vals, vecs = np.linalg.eigh((c + c.T) / 2)
    keep = vals > vals.max() * 1e-9 if vals.max() > 0 else vals > 0
    if not keep.any():
        return np.zeros((BUCKETS, RANK), np.float32)
    factor = y @ (vecs[:, keep] / np.sqrt(vals[keep]))
    u, _, _ = np.linalg.svd(factor, full_matrices=False)
    out = np.zeros((BUCKETS, RANK), np.float32)
    out[:, : min(RANK, u.shape[1])] = u[:, :RANK]
    return out


def _blocks_of(a: np.ndarray, b: np.ndarray, least: int = 2) -> list[tuple[int, int, int]]:
    """Maximal runs of equal codes in two sequences: (place in a, place in b, length), by place in a."""
    i, j = np.nonzero(a[:, None] == b[None, :])
    if not len(i):
        return []
    order = np.lexsort((i, j - i))
    i, j = i[order], j[order]
    first = np.flatnonzero(np.concatenate([[True], (np.diff(i) != 1) | (np.diff(j - i) != 0)]))
    size = np.diff(np.append(first, len(i)))
    keep = size >= least
    return sorted(zip(i[first[keep]].tolist(), j[first[keep]].tolist(), size[keep].tolist(), strict=True))


def run_length(a: np.ndarray, b: np.ndarray, weight: np.ndarray, least: int = SPAN) -> int:
    """The longest common subsequence of two code arrays that is a running passage: blocks of equal words in order,
    at most a word apart on either side, at most one word replaced in REPLACED. Its length in words of a, where
    weight counts a compound's parts as one word; 0 if it is shorter than `least`."""
    if weight.sum() < least or len(b) < least // 2:
        return 0
    upto = np.concatenate([[0], np.cumsum(weight)])
    blocks = _blocks_of(a, b)
    best = 0
    longest = max((n for _, _, n in blocks), default=0)
    # chains of blocks: (words so far, replaced so far) of the best chain that ends with each block, from any start
    ends: list[list[tuple[int, int, int]]] = []  # per block: (start in a, replaced, place)
    for k, (i, j, n) in enumerate(blocks):
        mine = {(i, 0)}
        for q in range(k - 1, -1, -1):
            pi, pj, pn = blocks[q]
            if pi + longest + 3 < i:
                break
            ga, gb = i - pi - pn, j - pj - pn
            # a replaced word may be a compound on either side; two words replaced together are no single ones
            if 0 <= ga <= 3 and 0 <= gb <= 3 and upto[i] - upto[pi + pn] <= 1:
                mine |= {(s, m + 1) for s, m in ends[q]}
        # of chains with as many replacements the one that began first is best
        top: dict[int, int] = {}
        for s, m in mine:
            top[m] = min(s, top.get(m, s))
        ends.append([(s, m) for m, s in top.items() if m <= len(a) // REPLACED + 1])
        for s, m in ends[-1]:
            words_in = int(upto[i + n] - upto[s])
            if m * REPLACED <= words_in and words_in > best:
                best = words_in
    return best if best >= least else 0


def _windows(seq: np.ndarray, bounds: np.ndarray, table: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unit vectors of windows of about SPAN words, every `step` words of each text; their text and first word."""
    starts = _blocks(bounds, step)
    if not len(starts):
        return np.zeros((0, table.shape[1]), np.float32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    text = np.searchsorted(bounds, starts, side="right") - 1
    # a text's blocks in one sum each, a window from as many blocks as span it
    sums = np.concatenate([np.add.reduceat(table[(seq[a:z] % BUCKETS).astype(np.int64)], s - a, axis=0) for a, z, s in _pieces(starts, len(seq))])
    wide = SPAN // step
    v = sums.copy()
    for k in range(1, wide):
        same = text[k:] == text[:-k]
        v[:-k] += sums[k:] * same[:, None]
    first = text != np.concatenate([[-1], text[:-1]])
    whole = np.concatenate([text[wide - 1 :] == text[: len(text) - wide + 1], np.zeros(min(wide - 1, len(text)), bool)]) if len(text) >= wide else np.zeros(len(text), bool)
    keep = whole | first
    v = v[keep]
    v /= np.linalg.norm(v, axis=1, keepdims=True) + 1e-9
    return v, text[keep], starts[keep]


def _pieces(starts: np.ndarray, end: int, size: int = 8192) -> Iterator[tuple[int, int, np.ndarray]]:
    """Blocks in groups that fit the cache: first word, last word, the blocks' starts."""
    for low in range(0, len(starts), size):
        s = starts[low : low + size]
        yield int(s[0]), int(starts[low + size]) if low + size < len(starts) else end, s


def _grams(seq: np.ndarray) -> np.ndarray:
    """A 64-bit code of each three words running."""
    s = seq.astype(np.uint64)
    return (s[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ (s[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (s[2:] * np.uint64(0x165667B19E3779F9)) if len(s) > 2 else s[:0]


def search(seqs: DataFrame, items: list[tuple[int, np.ndarray, np.ndarray]], idf: np.ndarray, vectors: np.ndarray, cosine: float) -> DataFrame:
    """(doc_id, item_id, run_words, cosine): documents with a run of SPAN words or more of an item."""
    spark = seqs.sparkSession
    used = np.flatnonzero(np.any(vectors != 0, axis=1))
    shared = spark.sparkContext.broadcast((used.astype(np.int32), (vectors[used] * idf[used][:, None]).astype(np.float32), items, cosine))  # at most BUCKETS x RANK

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, rows, queries, least = shared.value
        table = np.zeros((BUCKETS, RANK), np.float32)
        table[at] = rows
        qseq = np.concatenate([q for _, q, _ in queries]) if queries else np.zeros(0, np.uint32)
        qbounds = np.concatenate([[0], np.cumsum([len(q) for _, q, _ in queries])]).astype(np.int64)
        qv, qtext, _ = _windows(qseq, qbounds, table, STEP)
        # all threes of words of all items, by code: item and place of each
        parts = [_grams(q) for _, q, _ in queries]
        flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        by = np.argsort(flat, kind="stable")
        gram, gitem = flat[by], np.repeat(np.arange(len(parts)), [len(p) for p in parts])[by]
        gplace = np.concatenate([np.arange(len(p)) for p in parts])[by] if parts else by
        # a sieve of 2^20 places: most threes of words of the corpus are in no item
        sieve = np.zeros(1 << 20, bool)
        sieve[(gram & np.uint64(0xFFFFF)).astype(np.int64)] = True
        for pdf in batches:
            out = []
            for low in range(0, len(pdf), 64):
                part = pdf.iloc[low : low + 64]
                seq, bounds = _sequences(part)
                v, text, _ = _windows(seq, bounds, table, 2 * STEP)
                if not len(v) or not len(qv):
                    continue
                ids = part["id"].to_numpy()
                hits = []
                for w in range(0, len(v), 2048):
                    cos = v[w : w + 2048] @ qv.T
                    r, c = np.divmod(np.flatnonzero(cos.ravel() >= least), cos.shape[1])
                    hits.append(np.column_stack([text[w + r], qtext[c], cos[r, c]]))
                hits = np.concatenate(hits)
                if not len(hits):
                    continue
                pair = (hits[:, 0] * len(queries) + hits[:, 1]).astype(np.int64)
                order = np.lexsort((-hits[:, 2], pair))
                first = order[np.flatnonzero(np.diff(pair[order], prepend=-1))]
                candidates = pair[first]
                top = dict(zip(candidates.tolist(), hits[first, 2].tolist(), strict=True))
                # threes of words that a document shares with its candidate items, and how far apart they stand
                mine = _grams(seq)
                spots = np.flatnonzero(sieve[(mine & np.uint64(0xFFFFF)).astype(np.int64)])
                mine = mine[spots]
                doc = np.searchsorted(bounds, spots, side="right") - 1
                lo, hi = np.searchsorted(gram, mine), np.searchsorted(gram, mine, side="right")
                n = hi - lo
                which = np.repeat(np.arange(len(mine)), n)
                entry = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
                key = doc[which] * len(queries) + gitem[entry]
                asked = np.zeros(len(part) * len(queries), bool)
                asked[candidates] = True
                keep = asked[key] & (np.bincount(key, minlength=len(asked)) >= GRAMS)[key]
                key, off, spot = key[keep], (spots[which] - gplace[entry])[keep], spots[which][keep]
                order = np.lexsort((off, key))
                key, off, spot = key[order], off[order], spot[order]
                # forty words with one in ten replaced keep GRAMS threes of words at about one distance
                far = GRAMS - 1
                good = np.flatnonzero((key[far:] == key[: len(key) - far]) & (off[far:] - off[: len(off) - far] <= 8))
                for p in np.unique(key[good]).tolist():
                    x, y = divmod(p, len(queries))
                    _, q, weight = queries[y]
                    best, last = 0, -1
                    for g in good[key[good] == p]:
                        if g <= last:
                            continue
                        last = g + far
                        around = spot[g : g + GRAMS]
                        a, b = max(bounds[x], around.min() - len(q)), min(bounds[x + 1], around.max() + len(q))
                        best = max(best, run_length(q, seq[a:b], weight))
                    if best >= SPAN:
                        out.append((int(ids[x]), int(queries[y][0]), best, top[p]))
            yield pd.DataFrame(out, columns=["doc_id", "item_id", "run_words", "cosine"])

    return seqs.mapInPandas(run, "doc_id bigint, item_id bigint, run_words int, cosine double")


def leaks(docs: DataFrame, items: DataFrame, cosine: float = 0.82, block: int = 5_000) -> DataFrame:
    """(doc_id, item_id, run_words, cosine): every document that holds a leaked passage of an item.

    Items go to the tasks in blocks of `block`, however many there are; each block is one pass over the coded documents.
    """
    scratch = Scratch(docs.sparkSession, "leaks")
    seqs = scratch.keep(encode(docs, "doc_id", "text"), "seqs")
    query = scratch.keep(items.select("item_id", "item_text").filter("item_id is not null and item_text is not null").dropDuplicates(["item_id"]), "items")
    df = document_frequency(seqs) + document_frequency(encode(query, "item_id", "item_text"))
    idf = np.where(df > 0, np.log((1 + df.max()) / (1 + df)) + 0.05, 0.0)
    vectors = basis(seqs, idf)
    found, held = None, []

    def search_block() -> DataFrame:
        part = scratch.keep(search(seqs, held, idf, vectors, cosine), "found")
        return part if found is None else found.unionByName(part)

    for r in query.toLocalIterator():
        weight = weights(r.item_text)
        if weight.sum() >= SPAN:
            held.append((int(r.item_id), codes(r.item_text), weight))
        if len(held) == block:
            found, held = search_block(), []
    if held or found is None:
        found = search_block()
    return found.groupBy("doc_id", "item_id").agg(F.max("run_words").alias("run_words"), F.max("cosine").alias("cosine"))


def answers(found: DataFrame, docs: DataFrame, items: DataFrame) -> DataFrame:
    """Adds whether the document also holds the item's answer as a word of its own: a stronger sign of a copied test item."""
    asked = items.select("item_id", F.lower("answer").alias("_a")).dropDuplicates(["item_id"])
    texts = docs.select("doc_id", F.lower("text").alias("_t")).join(found.select("doc_id").distinct(), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    joined = found.join(F.broadcast(asked), "item_id", "left").join(texts, "doc_id", "left")
    near = F.expr("_t rlike concat('(?<![\\\\w])', '\\\\Q', _a, '\\\\E', '(?![\\\\w])')")
    return joined.select("doc_id", "item_id", "run_words", "cosine", F.coalesce(near, F.lit(False)).alias("answer_in_text"))
