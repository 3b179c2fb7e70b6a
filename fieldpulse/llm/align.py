"""Alignment of two tokenizers' tokens by pointer jumping.

Both tokenizers cut the same bytes. A token overlaps tokens of the other side; it points to the one that
reaches farthest right (an equal end: to the first side's token, which then points to itself). Following the
pointers leads every token to the last token of its group, the stretch between two byte offsets at which
tokens of both sides end. Successors are doubled (``next = next[next]``) over all tokens at once until nothing
changes, so a group of n tokens takes log n steps. The tokens with one terminal are a group.

Within a group every token of one side is linked with every token of the other. Links are counted by id pair;
a group's ids are counted before they are paired, so a long group makes as many pairs as it has different ids,
and pairs of one task are added up before the next are made.

Texts are encoded whole and aligned many at a time. A very long text is encoded in stretches that end before
a single space between two other characters: both tokenizers end a token there (words carry the space in front
of them, the first side's pattern never joins what lies on both sides, and no piece of the second has the mark
behind another character).

How many documents hold a pair is summed over *blocks* of documents: a task names each pair of a block once,
with the number of the block's documents that hold it, and numbers it. Documents keep numbers of pairs alone.
Counts come back to a block as one short list. Nothing that grows with the corpus is broadcast or collected.

Null and empty texts, and texts whose tokens' bytes are not the text's (the second side writes the mark itself
as a space), have no tokens. Repeated rows are documents of their own. Extra columns are not read.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from fieldpulse.llm._common import map_batches, read_table, slices, staged
from fieldpulse.llm.piece_bpe import MARK, loaded, model_bytes

#: A block of documents, in characters of text (one document at least).
BLOCK_CHARS = 4 << 20
#: Texts aligned at once in characters (one text at least), the longest stretch encoded at once, pairs made at once.
BATCH_CHARS, STRETCH_CHARS, PAIRS_AT_ONCE = 1 << 20, 1 << 20, 1 << 21
#: A space between two characters that are surely no white space to either tokenizer.
CUT = re.compile(r"(?<=[^\s᠎​﻿]) (?=[^\s᠎​﻿])")


def byte_table() -> dict[str, int]:
    """The characters byte-level vocabularies write bytes as: printable bytes as themselves, the others in
    order from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return out | {chr(256 + i): b for i, b in enumerate(rest)}


#: How byte-level tokenizers of this kind cut a text before merging (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteLevel:
    """The first side: a byte-level tokenizer given as its JSON. Its merges are in the order of their ids
    (checked), so merging by rank is the same, and special tokens' strings are plain text."""

    def __init__(self, spec: bytes):
        import tiktoken

        said = json.loads(spec)
        model, table = said["model"], byte_table()
        before = said.get("pre_tokenizer") or {}
        if model["type"] != "BPE" or said.get("normalizer") or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
            raise ValueError("not a byte-level tokenizer of the usual pattern")
        ranks = {bytes(table[c] for c in token): i for token, i in model["vocab"].items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        if any(model["vocab"]["".join(m)] != 256 + i for i, m in enumerate(pairs)):
            raise ValueError("merges out of order")
        self.tokenizer = tiktoken.Encoding("first side", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes_of[i] = token
        self.length_of = np.array([len(b) for b in self.bytes_of], dtype=np.int64)

    def encode(self, text: str) -> list[int]:
        return self.tokenizer.encode_ordinary(text)


def group_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For tokens of two sides that cut the same bytes (their end offsets, ascending): the number of each
    token's group, by side. Groups are numbered in order."""
    na, nb = len(ends_a), len(ends_b)
    # the other side's token that holds a token's last byte is the last one it overlaps
    a_to, b_to = np.searchsorted(ends_b, ends_a), np.searchsorted(ends_a, ends_b)
    nxt = np.empty(na + nb, dtype=np.int64)
    nxt[:na] = np.where(ends_b[a_to] > ends_a, na + a_to, np.arange(na))
    nxt[na:] = b_to  # ends later, or at the same place
    while True:
        far = nxt[nxt]
        if np.array_equal(far, nxt):
            break
        nxt = far
    is_end = np.zeros(na, dtype=np.int64)
    is_end[nxt[:na]] = 1
    number = np.cumsum(is_end) - 1  # of the group that ends with this token
    return number[nxt[:na]], number[nxt[na:]]


def _pairs(ids_a: np.ndarray, ids_b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, owner: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Linked id pairs, added up by owner of the group: ``(owner, pair code, links)``, several times."""
    def counted(group, ids):
        key, n = np.unique(group << 20 | ids, return_counts=True)
        return key >> 20, key & 0xFFFFF, n

    ga, a, na = counted(group_a, ids_a)
    gb, b, nb = counted(group_b, ids_b)
    size = np.bincount(gb, minlength=len(owner))
    first = np.cumsum(size) - size
    made = np.cumsum(size[ga])
    at = 0
    while at < len(ga):  # whole ids of the first side: an id makes at most as many pairs as the second has ids
        to = max(at + 1, int(np.searchsorted(made, (made[at - 1] if at else 0) + PAIRS_AT_ONCE, side="right")))
        n = size[ga[at:to]]
        ends = np.cumsum(n)
        left = np.repeat(np.arange(at, to), n)
        right = np.repeat(first[ga[at:to]] - ends + n, n) + np.arange(ends[-1])
        key, code = owner[ga[left]], a[left] << 20 | b[right]
        links = na[left] * nb[right]
        both = (key - key[0]) << 40 | code if key[-1] - key[0] < 1 << 22 else None
        order = np.lexsort((code, key)) if both is None else np.argsort(both)
        yield _added(key[order], code[order], links[order])
        at = to


def stretches(text: str) -> Iterator[tuple[int, int]]:
    """The text in stretches of ``STRETCH_CHARS`` or a little more; all but the first begin at a space."""
    at = 0
    while len(text) - at > STRETCH_CHARS:
        space = CUT.search(text, at + STRETCH_CHARS)
        if space is None:
            break
        yield at, space.start()
        at = space.start()
    yield at, len(text)


class Aligner:
    """Tokens, groups and links of texts, many at a time."""

    def __init__(self, first: bytes, second: bytes):
        from sentencepiece import SentencePieceProcessor

        self.a, self.b = ByteLevel(first), loaded(second)
        self.b_encoder = SentencePieceProcessor(model_proto=second)
        if max(len(self.a.bytes_of), len(self.b.bytes_of)) >= 1 << 20:
            raise ValueError("a vocabulary of more than a million tokens")
        names = range(max(len(self.a.bytes_of), len(self.b.bytes_of)))
        self.written = np.array([[f"{i}{after}" for i in names] for after in (",", "|", ";", "")], dtype=object)  # an id and what follows
        if any(MARK in p.lstrip(MARK) for p in self.b.id):
            raise ValueError("pieces that reach over a space")

    def encode(self, text: str) -> tuple[list[int], list[int]]:
        a, b = [], []
        for lo, hi in stretches(text):
            a += self.a.encode(text[lo:hi] if lo else " " + text[lo:hi])
            b += self.b_encoder.encode(text[lo + 1:hi] if lo else text[lo:hi])  # it puts a space in front itself
        return a, b

    def _same(self, raw: bytes, a: list[int], b: list[int]) -> bool:
        return b"".join(map(self.a.bytes_of.__getitem__, a)) == raw == b"".join(map(self.b.bytes_of.__getitem__, b))

    def align(self, texts: list[str]) -> tuple[np.ndarray, list[str], list[tuple[np.ndarray, ...]]]:
        """By text: tokens of both sides, groups and links (four columns) and the groups as text; and chunks of
        ``(text's number, pair code, links)``, sorted by number and code, each pair of a text once. Texts without
        tokens have zeros."""
        kept, ids_a, ids_b = [], [], []
        for k, t in enumerate(texts):
            if t:
                a, b = self.encode(t)
                if self._same(b" " + t.encode(), a, b):
                    kept.append(k)
                    ids_a.append(a)
                    ids_b.append(b)
        totals, said = np.zeros((len(texts), 4), np.int64), [""] * len(texts)
        if not kept:
            return totals, said, []
        na, nb = (np.array([len(x) for x in ids]) for ids in (ids_a, ids_b))
        a, b = (np.concatenate([np.array(x, np.int64) for x in ids]) for ids in (ids_a, ids_b))
        group_a, group_b = group_ends(np.cumsum(self.a.length_of[a]), np.cumsum(self.b.length_of[b]))
        size_a, size_b = np.bincount(group_a), np.bincount(group_b)
        owner = np.empty(len(size_a), dtype=np.int64)
        owner[group_a] = np.repeat(np.arange(len(kept)), na)
        first = np.searchsorted(owner, np.arange(len(kept)))
        totals[kept] = np.stack([na, nb, np.bincount(owner), np.add.reduceat(size_a * size_b, first)], axis=1)
        for k, words in zip(kept, _said(a, group_a, size_a, b, group_b, size_b, np.cumsum(na), np.cumsum(nb), self.written)):
            said[k] = words
        return totals, said, _merged(list(_pairs(a, b, group_a, group_b, np.array(kept)[owner])))


def _merged(chunks: list[tuple[np.ndarray, ...]]) -> list[tuple[np.ndarray, ...]]:
    """A group's pairs may lie in several chunks: each pair of a text once."""
    if len(chunks) < 2:
        return chunks
    owner, code, n = (np.concatenate([c[i] for c in chunks]) for i in range(3))
    order = np.lexsort((code, owner))
    return [_added(owner[order], code[order], n[order])]


def _added(owner: np.ndarray, code: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    new = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (code[1:] != code[:-1]))))
    return owner[new], code[new], np.add.reduceat(n, new)


def _said(a: np.ndarray, group_a: np.ndarray, size_a: np.ndarray, b: np.ndarray, group_b: np.ndarray, size_b: np.ndarray,
          ends_a: np.ndarray, ends_b: np.ndarray, written: np.ndarray) -> Iterator[str]:
    """``a1,a2|b1;a3|b2`` of each text: its tokens merged by group, each followed by what comes after it."""
    upto_a, upto_b = np.cumsum(size_a), np.cumsum(size_b)
    at_a, at_b = np.arange(len(a)) + (upto_b - size_b)[group_a], np.arange(len(b)) + upto_a[group_b]
    ids, after = np.empty(len(a) + len(b), np.int64), np.zeros(len(a) + len(b), np.int8)
    ids[at_a], ids[at_b] = a, b
    after[at_a[upto_a - 1]] = 1
    after[at_b[upto_b - 1]] = 2
    ends = ends_a + ends_b
    after[ends - 1] = 3
    words = written[after, ids].tolist()
    at = 0
    for end in ends.tolist():
        yield "".join(words[at:end])
        at = end


_ALIGNERS: dict[tuple[int, int], Aligner] = {}


def aligner(first: bytes, second: bytes) -> Aligner:
    key = (hash(first), hash(second))
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(first, second)
    return _ALIGNERS[key]


def aligned(docs: DataFrame, first: str | bytes, second: str | bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a document and one row a pair of a block.

    Documents: ``block, key, n_a, n_b, n_groups, n_links, groups`` (text), ``pairs`` and ``links`` (binary, 32-bit
    numbers of the block's pairs and 64-bit links of each; no links: one each). Pairs: ``block, pair, a, b, n`` (documents).
    """
    one, two = model_bytes(first), model_bytes(second)
    inner = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
                        F.spark_partition_id().alias("task"))
    key_type = to_arrow_type(inner.schema["key"].dataType)
    fields = [("block", pa.int64()), ("key", key_type), *[(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")], ("groups", pa.string()),
              ("pairs", pa.binary()), ("links", pa.binary()), ("pair", pa.int32()), ("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())]
    schema = pa.schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, block, held, number, docs_of = aligner(one, two), None, 0, {}, np.zeros(0, np.int64)

        def close():
            if number:
                code = np.fromiter(number, np.int64, len(number))
                gone = lambda t: pa.nulls(len(code), t)
                cols = {"block": pa.array(np.full(len(code), block)), "pair": pa.array(np.arange(len(code), dtype=np.int32)),
                        "a": pa.array((code >> 20).astype(np.int32)), "b": pa.array((code & 0xFFFFF).astype(np.int32)), "n": pa.array(docs_of)}
                yield pa.RecordBatch.from_arrays([cols[f.name] if f.name in cols else gone(f.type) for f in schema], schema=schema)

        for batch in batches:
            keys, texts = batch.column(0), batch.column(1).to_pylist()
            sizes = [len(t) for t in texts]
            for lo, hi in slices(sizes, min(BATCH_CHARS, BLOCK_CHARS)):
                size = sum(sizes[lo:hi])
                if block is None or held + size > BLOCK_CHARS:
                    yield from close()
                    block = (block + 1) if block is not None else batch.column(2)[0].as_py() << 32
                    held, number, docs_of = 0, {}, np.zeros(0, np.int64)
                held += size
                totals, said, pairs = own.align(texts[lo:hi])
                numbers, links = [b""] * (hi - lo), [b""] * (hi - lo)
                for owner, code, n in pairs:
                    named, which, times = np.unique(code, return_inverse=True, return_counts=True)
                    named = np.array([number.setdefault(c, len(number)) for c in named.tolist()])
                    docs_of = np.concatenate((docs_of, np.zeros(len(number) - len(docs_of), np.int64)))
                    docs_of[named] += times
                    at = named[which].astype(np.int32)
                    cut = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1], [True])))
                    plain = np.maximum.reduceat(n, cut[:-1]) == 1
                    for k, x, y, ones in zip(owner[cut[:-1]].tolist(), cut.tolist(), cut[1:].tolist(), plain.tolist()):
                        numbers[k], links[k] = at[x:y].tobytes(), b"" if ones else n[x:y].tobytes()
                cols = [pa.array(np.full(hi - lo, block)), keys.slice(lo, hi - lo), *[pa.array(c) for c in totals.T.copy()], pa.array(said, pa.string()),
                        pa.array(numbers, pa.binary()), pa.array(links, pa.binary())]
                yield pa.RecordBatch.from_arrays([*cols, *[pa.nulls(hi - lo, f.type) for f in list(schema)[9:]]], schema=schema)
        yield from close()

    spark_schema = (f"block bigint, key {inner.schema['key'].dataType.simpleString()}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
                    "pairs binary, links binary, pair int, a int, b int, n bigint")
    return map_batches(inner, run, spark_schema)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """``a, b, count, best``: documents that hold the pair, and whether no pair of its first id has more."""
    counts = staged(pairs.groupBy("a", "b").agg(F.sum("n").alias("count")), "align-counts")
    top = counts.groupBy("a").agg(F.max("count").alias("top"))
    return counts.join(top, "a").select("a", "b", "count", (F.col("count") == F.col("top")).alias("best"))


def scored(docs: DataFrame, pairs: DataFrame, counts: DataFrame) -> DataFrame:
    """``key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups``: a block's documents meet the counts of its
    pairs."""
    lists = pairs.select("block", "pair", "a", "b").join(counts, ["a", "b"]).select(F.col("block").alias("of"), "pair", "count", "best")
    kept = ["key", "n_a", "n_b", "n_groups", "n_links", "groups"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        count, best = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, np.int64)
        pair = right["pair"].to_numpy()
        count[pair], best[pair] = right["count"].to_numpy(), right["best"].to_numpy()
        out = []
        for at, links in zip(left["pairs"].to_pylist(), left["links"].to_pylist()):
            at = np.frombuffer(at, np.int32)
            links = np.frombuffer(links, np.int64) if links else 1
            out.append((int((links * best[at]).sum()), int((links * count[at]).sum())))
        sums = [pa.array([o[i] for o in out], pa.int64()) for i in (0, 1)]
        return pa.table([*[left[c] for c in kept], *sums], names=[*kept, "n_best", "count_sum"])

    return docs.select("block", *kept, "pairs", "links").groupBy("block").cogroup(lists.groupBy("of")).applyInArrow(
        run, f"key {docs.schema['key'].dataType.simpleString()}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, n_best bigint, count_sum bigint")


def op12_align(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    made = aligned(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    made = staged(made.withColumn("groups", F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))), "align", "zstd")
    rows, pairs = made.filter("n_a IS NOT NULL"), made.filter("n IS NOT NULL")
    out = scored(rows, pairs, pair_counts(pairs))
    return out.select(F.col("key").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))
