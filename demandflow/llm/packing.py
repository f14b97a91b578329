"""Packing: first-fit decreasing with a tournament tree of bin capacities, run independently
in randomised groups of documents.

Documents become token ids; a document longer than a sequence is cut into full pieces and one
rest.  Every piece goes to a random group, and each group is packed by itself: its pieces in
decreasing length, each into the first open sequence with room, found in O(log bins) in a
tournament tree whose inner nodes hold the largest free capacity below them.  A group holds
about ``group_pieces`` pieces whatever the input size, so the work is linear, one task's memory
is bounded, and what is lost to packing groups apart is at most a few sequences in each.

Null text counts as empty (one piece that holds the end id).  Repeated rows are packed as
separate documents; a null id is kept.  An empty table gives an empty result.  Extra columns
are dropped by :func:`pieces`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandflow.llm.common import Scratch, slices, word_lists

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("doc_tokens", T.LongType()),
    T.StructField("ids", T.BinaryType()),
])
_ARROW = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                    ("doc_tokens", pa.int64()), ("ids", pa.binary())])


_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


class WordTokenizer:
    """Ids of texts, by looking words up in a kept dictionary of bounded size.

    The tokenizer lower-cases, drops white space and never makes a token across it, so a
    text's ids are those of its words in a row.  Letters are one word to the tokenizer, whose
    last token is marked as a word end: many new ones are encoded in one call and cut at these
    marks.  Punctuation after letters is encoded apart from them.  Anything else is encoded as
    it is.  Only parts of words that are new to the dictionary become Python strings.
    """

    def __init__(self, path: str, cache: int = 400_000, cache_bytes: int = 50_000_000):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # a-z needs none of the normalising: the same vocabulary with words cut at spaces
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab()
        self.is_end = np.zeros(max(vocabulary.values()) + 1, bool)
        self.is_end[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.cache, self.cache_bytes = cache, cache_bytes
        self.known = pa.array([], pa.string())
        self.size, self.pool = np.zeros(0, np.int64), np.zeros(0, "<u4")

    def _each(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each chunk, and all ids."""
        ids: list[list[int]] = []
        for i in range(0, len(chunks), 1000):
            ids += [e.ids for e in self.tokenizer.encode_batch_fast(chunks[i:i + 1000], add_special_tokens=False)]
        return np.fromiter(map(len, ids), np.int64, len(ids)), np.array([x for own in ids for x in own], "<u4")

    def _together(self, tokenizer, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = []
        for i in range(0, len(words), 4000):
            own = words[i:i + 4000]
            ids = np.array(tokenizer.encode_batch_fast([" ".join(own)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.is_end[ids]) + 1
            if len(ends) == len(own):
                found.append((np.diff(np.r_[0, ends]), ids))
            else:  # a letter that lower-cases to more than letters
                found.append(self._each(own))
        return np.concatenate([n for n, _ in found]), np.concatenate([ids for _, ids in found])

    def _learn(self, new: pa.Array) -> None:
        """Add these parts to the dictionary."""
        plain = pc.match_substring_regex(new, "^[a-z]+$")
        letters = pc.and_not(pc.utf8_is_alpha(new), plain)
        other = pc.invert(pc.or_(plain, letters))
        for kind, encode in ((plain, lambda w: self._together(self.plain, w)), (letters, lambda w: self._together(self.tokenizer, w)),
                             (other, self._each)):
            parts = new.filter(kind)
            if len(parts):
                size, ids = encode(parts.to_pylist())
                self.known = pa.concat_arrays([self.known.cast(parts.type), parts])
                self.size, self.pool = np.r_[self.size, size], np.r_[self.pool, ids]

    def _places(self, parts: pa.Array) -> np.ndarray:
        """Place of each part in the dictionary."""
        at = pc.index_in(parts, value_set=self.known.cast(parts.type))
        if at.null_count:
            self._learn(parts.filter(pc.is_null(at)))
            at = pc.index_in(parts, value_set=self.known)
        return at.to_numpy().astype(np.int64)

    def _trim(self) -> None:
        """Forget the older half of a full dictionary."""
        n = len(self.known)
        if n > self.cache or self.known.nbytes + self.pool.nbytes > self.cache_bytes:
            self.pool = self.pool[self.size[:n // 2].sum():].copy()
            self.size = self.size[n // 2:].copy()
            self.known = pa.concat_arrays([self.known.slice(n // 2)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, flat (little-endian unsigned 32-bit), with the offsets of each."""
        # the names of special tokens count as written, before any lower-casing
        special = pc.any(pc.match_substring(texts, "<|")).as_py()
        flat, offsets = word_lists(texts, lower=not special)
        if not len(flat):
            return np.zeros(0, "<u4"), np.zeros_like(offsets)
        self._trim()
        coded = flat.dictionary_encode()
        words, codes = coded.dictionary, coded.indices.to_numpy()
        bases = pc.utf8_rtrim(words, characters=_PUNCTUATION)
        first = pc.if_else(pc.utf8_is_alpha(bases), bases, words)
        longer = pc.less(pc.binary_length(first), pc.binary_length(words))
        rest = [w[len(b):] for w, b in zip(words.filter(longer).to_pylist(), first.filter(longer).to_pylist(), strict=True)]
        parts = pa.concat_arrays([first, pa.array(rest, first.type)]).dictionary_encode()
        place = self._places(parts.dictionary)[parts.indices.to_numpy()]
        second = np.full(len(words), -1)
        second[longer.to_numpy(zero_copy_only=False)] = place[len(words):]
        # each word is one part or two
        two = second[codes] >= 0
        word_at = np.r_[0, np.cumsum(1 + two)]
        seq = np.repeat(place[:len(words)][codes], 1 + two)
        seq[word_at[1:][two] - 1] = second[codes[two]]
        begin = np.cumsum(self.size) - self.size
        upto = np.r_[0, np.cumsum(self.size[seq])]
        at = np.arange(upto[-1]) + np.repeat(begin[seq] - upto[:-1], self.size[seq])
        return self.pool[at], upto[word_at[offsets]]


_loaded: dict[str, WordTokenizer] = {}


def _tokenizer(name: str) -> WordTokenizer:
    if name not in _loaded:
        import os

        import public_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _loaded[name] = WordTokenizer(public_tokenizers.path(name))
    return _loaded[name]


def pieces(docs: DataFrame, max_tokens: int = 2048, tokenizer: str = "word_bpe_49k.json", end_id: int = 1) -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, ids`` (ids: little-endian
    unsigned 32-bit).  ``tokenizer`` names a file of the public_tokenizers package on every
    machine."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = _tokenizer(tokenizer)
        for batch in batches:
            for part in slices(batch, "text", 8_000_000):
                flat, offsets = tok.encode(part.column("text"))
                total = np.diff(offsets) + 1
                ids = np.insert(flat, offsets[1:], np.uint32(end_id)).astype("<u4")
                pieces_of = -(-total // max_tokens)
                doc = np.repeat(np.arange(len(total)), pieces_of)
                nth = np.arange(len(doc)) - np.repeat(np.cumsum(pieces_of) - pieces_of, pieces_of)
                start = nth * max_tokens
                length = np.minimum(max_tokens, total[doc] - start)
                cuts = (4 * np.r_[0, np.cumsum(length)]).astype(np.int32)  # pieces follow each other as the ids do
                blob = pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(cuts), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(doc)), pa.array(start), pa.array(length),
                                                  pa.array(total[doc]), blob], schema=_ARROW)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, PIECES)


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item.  ``tree`` is a tournament over bin capacities: node ``i``
    holds the larger of nodes ``2i`` and ``2i + 1``; all bins begin empty, so the leftmost leaf
    with room is the first open bin that fits or else the next new one.  Items of equal length
    keep their order."""
    n = len(lengths)
    leaves = 1
    while leaves < n:
        leaves *= 2
    tree = [capacity] * (2 * leaves)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for item in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[item])
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        bins[item], offsets[item] = node - leaves, capacity - tree[node]
        left = tree[node] - size
        tree[node] = left
        while node > 1:
            other = tree[node ^ 1]
            node //= 2
            best = left if left > other else other
            if tree[node] == best:
                break
            tree[node] = left = best
    return bins, offsets


def pack(parts: DataFrame, scratch: Scratch, max_tokens: int = 2048, group_pieces: int = 8192, seed: int = 17) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` (gapless from 0 in a sequence) to pieces that have
    a ``length`` of at most ``max_tokens``; other columns are carried along."""
    parts = scratch.write(parts, "pieces")
    groups = max(1, -(-parts.count() // group_pieces))
    schema = T.StructType([*parts.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def pack_group(rows: pa.Table) -> pa.Table:
        group = rows.column("_group")[0].as_py()
        bins, offsets = first_fit_decreasing(rows.column("length").to_numpy(), max_tokens)
        out = rows.drop_columns(["_group"])
        return out.append_column("sequence_id", pa.array(bins + (group << 32))).append_column("offset", pa.array(offsets))

    # the group is drawn per row, not per id: repeated ids spread like any others
    dealt = parts.withColumn("_group", F.floor(F.rand(seed) * groups).cast("long"))
    return dealt.groupBy("_group").applyInArrow(pack_group, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves from packed pieces that carry ``ids``: one row per sequence of
    at most ``max_tokens`` ids (``sequence_id, n_tokens, ids``), unpadded."""
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.expr("aggregate(sort_array(collect_list(struct(offset, ids))), cast('' as binary), (a, x) -> concat(a, x.ids))").alias("ids"))
