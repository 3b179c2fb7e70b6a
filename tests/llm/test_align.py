"""Alignment of two tokenizers against both libraries and plain Python."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from fieldpulse.llm import align

P = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"


def plain_tokens():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    one.encode_special_tokens = True
    two = SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    table = align.byte_table()

    def piece(i):
        p = two.id_to_piece(i)
        return bytes([int(p[3:-1], 16)]) if two.is_byte(i) else p.replace("▁", " ").encode()

    def tokens(text):
        a = one.encode(" " + text, add_special_tokens=False).ids
        b = two.encode(text)
        return [(i, bytes(table[c] for c in one.id_to_token(i))) for i in a], [(i, piece(i)) for i in b]

    return tokens


def plain(docs):
    tokens = plain_tokens()
    out, held = [], Counter()
    for doc, text in docs:
        groups = []
        if text:
            a, b = tokens(text)
            raw = b" " + text.encode()
            if b"".join(x for _, x in a) == raw == b"".join(x for _, x in b):
                ends = [np.cumsum([len(x) for _, x in side]).tolist() for side in (a, b)]
                cuts = sorted(set(ends[0]) & set(ends[1]))
                groups = [([], []) for _ in cuts]
                for s, side in enumerate((a, b)):
                    at = 0
                    for (i, _), e in zip(side, ends[s]):
                        while cuts[at] < e:
                            at += 1
                        groups[at][s].append(i)
        links = Counter((x, y) for a, b in groups for x in a for y in b)
        held.update(links.keys())
        out.append((doc, groups, links))
    top = defaultdict(int)
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    rows = []
    for doc, groups, links in out:
        said = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        rows.append((doc, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(links.values()),
                     sum(n for p, n in links.items() if held[p] == top[p[0]]), sum(n * held[p] for p, n in links.items()),
                     hashlib.sha256(said.encode()).hexdigest() if groups else ""))
    return sorted(rows, key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_group_ends_against_common_offsets():
    rng = np.random.default_rng(4)
    for _ in range(500):
        n = int(rng.integers(1, 60))
        a, b = (np.unique(np.append(rng.integers(1, n + 1, rng.integers(0, n + 1)), n)) for _ in range(2))
        cuts = np.intersect1d(a, b)
        ga, gb = align.group_ends(a, b)
        assert ga.tolist() == np.searchsorted(cuts, a).tolist() and gb.tolist() == np.searchsorted(cuts, b).tolist()


def test_query_against_plain(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert result(align.op12_align(spark, SF)) == plain(docs)


def odd_docs():
    rng = random.Random(6)
    texts = [None, "", " ", "  two  spaces ", "a▁b", "one ▁ two", "<|endoftext|> <s>", "\n\n a\tb\r\n", "日本語の文章です。 そう", "\U0001F600\U0001F601 é", "don't we'll",
             "x" * 3000, "ab" * 800 + "yz" * 700, " " * 500, "\x00 \x1c \x85 \xa0 a", "a ​ b ﻿ c", "=" * 77 + " " + "-" * 66, "words " * 3000]
    for _ in range(150):
        texts.append("".join(rng.choice(["a", "the", " ", "  ", "\n", "é", "ou", "ing", ".", "12", "日", "'s", "　", "Q", "\xa0"]) for _ in range(rng.randint(1, 60))))
    return [(None if i == 3 else i // 2, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("small", [False, True])
def test_odd_texts_repeats_and_small_blocks(spark, tmp_path, monkeypatch, small):
    if small:
        monkeypatch.setattr(align, "BLOCK_CHARS", 200)
        monkeypatch.setattr(align, "PAIRS_AT_ONCE", 50)
        monkeypatch.setattr(align, "STRETCH_CHARS", 20)
    docs = odd_docs() * 2
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as `a.b`", "2 as block", "'x' as pairs")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    assert result(align.op12_align(spark, str(tmp_path))) == plain(docs)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert align.op12_align(spark, str(tmp_path)).count() == 0


def test_groups_as_text(spark):
    df = spark.createDataFrame([("k", "Hello you")], "name string, body string")
    rows = align.aligned(df, P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model"), key="name", text="body").filter("n_a IS NOT NULL").collect()
    assert [(r.key, r.n_a, r.n_b, r.n_groups) for r in rows] == [("k", 2, 2, 2)] and rows[0].groups.count("|") == 2


def test_first_side_as_its_library():
    """Merging by rank gives the tokenizer's own ids, also for special tokens' strings and odd characters."""
    from tokenizers import Tokenizer

    with open(P.path("byte_bpe_50k.json"), "rb") as f:
        own = align.ByteLevel(f.read())
    lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    lib.encode_special_tokens = True
    texts = [t for _, t in odd_docs() if t] + [f"x{chr(c)} {chr(c)}1{chr(c)}\n" for c in range(0, 0x30000, 37) if not 0xD800 <= c < 0xE000]
    assert [own.encode(t) for t in texts] == [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
