"""Token alignment against a direct alignment of every document."""

import hashlib
import os
import random
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from curbair.llm import align, queries

A, B = (queries.tokenizer_path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
DATA = "/root/testdata/sf0.001"
NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def direct(rows):
    """Every document on its own, links as a list of all pairs."""
    a_tok, b_tok = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_tok.encode_special_tokens = True
    alphabet = {}
    for b in [*range(33, 127), *range(161, 173), *range(174, 256)]:
        alphabet[chr(b)] = b
    for i, b in enumerate(b for b in range(256) if b not in set(alphabet.values())):
        alphabet[chr(256 + i)] = b

    def a_bytes(i):
        return bytes(alphabet[c] for c in a_tok.id_to_token(i))

    def b_bytes(i):
        piece = b_tok.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if b_tok.is_byte(i) else piece.replace("▁", " ").encode()

    done = []
    for doc, text in rows:
        ia = a_tok.encode(" " + text, add_special_tokens=False).ids if text else []
        ib = b_tok.encode(text) if text else []
        pa, pb = list(map(a_bytes, ia)), list(map(b_bytes, ib))
        if not text or not b"".join(pa) == b"".join(pb) == (" " + text).encode():
            done.append((doc, [], 0, 0, []))
            continue
        ea, eb = np.cumsum(list(map(len, pa))).tolist(), np.cumsum(list(map(len, pb))).tolist()
        common = sorted(set(ea) & set(eb))
        groups = [([], []) for _ in common]
        for ids, ends, side in ((ia, ea, 0), (ib, eb, 1)):
            for i, end in zip(ids, ends, strict=True):
                groups[bisect_left(common, end)][side].append(i)
        done.append((doc, groups, len(ia), len(ib), [(x, y) for xs, ys in groups for x in xs for y in ys]))
    counts = Counter(pair for *_, links in done for pair in set(links))
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for doc, groups, na, nb, links in done:
        text = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in groups)
        out.append((doc, na, nb, len(groups), len(links), sum(counts[p] == best[p[0]] for p in links),
                    sum(counts[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return sorted(out, key=str)


def odd_rows():
    rng = random.Random(13)
    texts = [None, "", " ", "a", "  a  b ", "\nfoo bar\n", "x▁y z", "été 日本 🙂 \x00 x", "<|endoftext|> a <s> <0x41> </s>",
             "don't 's it 'll", "a b  c \x1c d \x85 e", "aaaa" * 500, "word " * 30_000, "one two", "one two", "ONE two"]
    texts += ["".join(rng.choice("ab 1\n.'é▁  \t日") for _ in range(rng.randint(1, 40))) for _ in range(200)]
    texts += ["the same text for a third of all"] * 100
    return [(None if i % 50 == 7 else i // 2, t) for i, t in enumerate(texts)]


def got(df):
    return sorted((tuple(r) for r in df.select(NAMES).collect()), key=str)


@pytest.mark.parametrize("frequent", [align.FREQUENT, 40, 0])
def test_alignments_equal_direct_ones(spark, frequent):
    rows = odd_rows()
    docs = spark.createDataFrame([(t, "x", d, 1, 2) for d, t in rows], "text string, key string, doc_id long, copies int, code int")
    assert got(align.alignments(docs, A, B, frequent=frequent)) == direct(rows)


def test_other_columns_and_an_empty_table(spark):
    empty = spark.createDataFrame([], "id long, body string")
    out = align.alignments(empty, A, B, "id", "body")
    assert out.columns == ["id", *NAMES[1:]] and out.count() == 0
    nothing = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert got(align.alignments(nothing, A, B)) == direct([(1, None), (2, "")])


def test_cuts_seen_before_give_the_same(spark):
    one = align.Aligner(A, B, remembered=3)
    many = align.Aligner(A, B)
    texts = [t for _, t in odd_rows() if t]
    for i in range(0, len(texts), 7):
        for x, y in zip(one.align(texts[i : i + 7]), many.align(texts[i : i + 7]), strict=True):
            assert np.array_equal(x, y)


def test_packing():
    for values in ([], [0], [255, 0], [256], [1 << 20, 3], [1 << 40, 1 << 33]):
        values = np.array(values, np.int64)
        assert align.unpack(align.pack(values)).tolist() == values.tolist()
        assert align.unpack_sorted(align.pack_sorted(np.sort(values))).tolist() == sorted(values.tolist())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="given tables absent")
def test_query_equals_direct_alignment(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    assert got(queries.QUERIES["op13_token_alignment"](spark, DATA)) == direct(rows)
