"""Operators on texts against brute force, libraries, round trips and held-out accuracy."""

import hashlib
import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from curbair.llm import jaccard, langid, mixture, pieces, queries, secrets, tokenfile

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"
needs_tables = pytest.mark.skipif(not os.path.isdir(DATA), reason="given tables absent")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


def odd_texts():
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(30_000))
    return [(1, None), (2, ""), (3, "   \n\t"), (4, "one two"), (5, "ONE  two"), (6, long), (7, long), (7, long),
            (None, "a b c d e f g"), (8, "a b c d e f g"), (9, "été 日本 🙂 ▁ \x00 x"), (9, "other words here now then ok")]


# near duplicates

def brute_components(rows, percent=80, words=5):
    low = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
    sets = []
    for _, text in rows:
        w = (text or "").encode().translate(low).split()
        sets.append({tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    names = {}
    for i, (d, _) in enumerate(rows):
        if d is not None and sets[i]:
            names[find(i)] = min(d, names.get(find(i), d))
    return sorted(((d, len(sets[i]), names.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def near_copies(seed, groups=8, size=12):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 4)))
    line = [word() for _ in range(8)]
    rows = []
    for _ in range(groups):
        base = [word() for _ in range(rng.randint(6, 120))]
        for _ in range(rng.randint(1, size)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = word()
            copy += line if rng.random() < 0.5 else []
            rows.append((len(rows), " ".join(copy).title() if rng.random() < 0.3 else "  ".join(copy)))
    return rows


@pytest.mark.parametrize(("seed", "rounds", "hot"), [(1, 6, 5000), (2, 0, 5000), (3, 1, 0)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, seed, rounds, hot):
    monkeypatch.setattr(jaccard, "HOT_ROWS", hot)  # 0: every shingle goes the split way
    rows = near_copies(seed)
    found = jaccard.near_duplicates(spark.createDataFrame(rows, SCHEMA), sketch_bits=16, rounds=rounds)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()), key=str)
    assert got == brute_components(rows)


def test_near_duplicates_on_odd_texts(spark):
    rows = odd_texts()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"id": F.lit("x"), "sig": F.lit(1), "component_id": F.lit(0)})
    got = sorted(((r.doc_id, r.n_shingles, r.component_id)
                  for r in jaccard.near_duplicates(df, sketch_bits=16).collect()), key=str)
    assert got == brute_components(rows)
    assert jaccard.near_duplicates(df.limit(0), sketch_bits=16).count() == 0
    kept = jaccard.one_of_each(df, sketch_bits=16)
    assert kept.columns == df.columns
    assert sorted((r.doc_id, (r.text or "")[:20]) for r in kept.collect()) == sorted(
        [(1, ""), (2, ""), (3, "   \n\t"), (4, "one two"), (6, odd_texts()[5][1][:20]), (8, "a b c d e f g"),
         (9, "été 日本 🙂 ▁ \x00 x"), (9, "other words here now then ok"[:20])])


def test_shingle_hashes_follow_words():
    same = jaccard.shingle_hashes("A b\tC d E f"), jaccard.shingle_hashes("a  b c\nd e F ")
    assert len(same[0]) == 2 and (same[0] == same[1]).all()
    assert len(jaccard.shingle_hashes("a b")) == 1 and len(jaccard.shingle_hashes("\x0b\x0c ")) == 0
    assert len(jaccard.shingle_hashes("é É")) == 1 and (jaccard.shingle_hashes("É x") != jaccard.shingle_hashes("é x")).all()


def test_words_that_polynomial_hashes_confuse_are_apart(spark):
    bits = "".join("ab"[i.bit_count() % 2] for i in range(1024))
    words = bits, bits.translate(str.maketrans("ab", "ba"))
    assert jaccard.shingle_hashes(words[0]) != jaccard.shingle_hashes(words[1])
    df = spark.createDataFrame([(1, words[0]), (2, words[1])], SCHEMA)
    assert sorted(r.component_id for r in jaccard.near_duplicates(df).collect()) == [1, 2]


def test_long_words_and_texts_hash_like_their_parts():
    long = "x" * 3_000_000 + " " + " ".join(f"w{i}" for i in range(300_000))
    expected = np.unique(np.concatenate([jaccard.shingle_hashes(" ".join(long.split()[i : i + 5])) for i in (0, 1, 200_000)]))
    assert np.isin(expected, jaccard.shingle_hashes(long)).all()


def test_parities_never_part_what_links():
    rng = np.random.default_rng(3)
    parted = 0
    for _ in range(400):
        both = rng.integers(0, 2**64, rng.integers(1, 700), dtype=np.uint64)
        more = [rng.integers(0, 2**64, rng.integers(0, 1 + len(both) // rng.integers(1, 9)), dtype=np.uint64) for _ in "ab"]
        x, y = (np.unique(np.append(both, m)) for m in more)
        shared = len(np.intersect1d(x, y))
        links = 100 * shared >= 80 * (len(x) + len(y) - shared)
        may = jaccard.may_link(jaccard.parities(x), jaccard.parities(y), 80)
        assert may or not links
        parted += not may
    assert parted > 100


def test_network_equals_a_naive_convolution():
    """Every filter at every position, one product after the other."""
    rng = np.random.default_rng(4)
    widths = np.repeat(langid.WIDTHS, 2)
    span, size = max(langid.WIDTHS), langid.EMBED
    filters = rng.normal(size=(span * size, len(widths)))
    for f, width in enumerate(widths):
        filters[width * size :, f] = 0
    net = langid.ByteConvNet(["a", "b", "c"], rng.normal(size=(256, size)), filters, rng.normal(size=len(widths)),
                             rng.normal(size=(len(widths), 3)), rng.normal(size=3))
    windows = langid.windows_of("Ein Satz, été 日本. ".encode() * 20)
    assert len(windows) == 2
    for window, found in zip(windows, net.probabilities(windows)):
        hidden = []
        for f, width in enumerate(widths):
            best = max(sum(net.embed[window[p + j]][d] * filters[j * size + d, f] for j in range(width) for d in range(size))
                       for p in range(len(window) - span + 1))
            hidden.append(max(0.0, best + net.bias[f]))
        z = [sum(h * net.dense[f][k] for f, h in enumerate(hidden)) + net.offset[k] for k in range(3)]
        e = np.exp(np.array(z) - max(z))
        assert np.allclose(found, e / e.sum())
    empty = langid.windows_of(b"")
    assert len(empty) == 1 and not empty.any()


# mixture

@pytest.mark.parametrize("cells", [100, 0])
def test_targets_that_cannot_be_met_are_told(spark, caplog, monkeypatch, cells):
    monkeypatch.setattr(mixture, "STEPS", 3)  # contradictions take every round there is
    table = spark.createDataFrame([("a", "x", 10), ("b", "y", 10)], "source string, lang string, tokens long")

    def missed(targets):
        found = mixture.calibrated(spark, table, ["source", "lang"], targets, cells)
        return {round(r.residual, 6) for r in found.collect()}

    assert missed({"source": {"a": 0.7, "b": 0.3}, "lang": {"x": 0.7, "y": 0.3}}) == {0.0} and not caplog.records
    assert min(missed({"source": {"a": 0.9, "b": 0.1}, "lang": {"x": 0.1, "y": 0.9}})) > 0.7
    assert "contradict" in caplog.text


# language

@needs_tables
def test_language_accuracy_on_held_out(spark):
    found = queries.QUERIES["op1_language_id"](spark, DATA.replace("0.001", "0.01"))
    truth = spark.read.parquet(f"{DATA.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "lang")
    rows = found.filter("held_out").join(truth, "doc_id").collect()
    assert len(rows) > 100 and sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_texts(spark):
    teach = [(i, t, g) for i in range(40) for t, g in (("the cat and the dog of it " * 3, "en"), ("der hund und die katze " * 3, "de"))]
    labelled = spark.createDataFrame(teach + [(99, None, "en"), (98, "the the", None), (97, "123", "de")], "doc_id long, text string, lang string")
    rows = odd_texts() + [(20, "12 34 !!"), (21, "der hund und die katze"), (22, "the dog and the cat " * 5000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"score": F.lit("x"), "__lang": F.lit(1)})
    found = langid.identify(df, labelled)
    assert found.columns == ["doc_id", "text", "__lang", "lang_pred", "score"]
    got = [(r.doc_id, r.lang_pred, r.score) for r in found.collect()]
    assert len(got) == len(rows)
    assert {g for i, g, _ in got if i in (1, 2, 3, 20)} == {"und"} and {s for i, _, s in got if i in (1, 2, 3, 20)} == {0.0}
    assert ("de", "en") == (next(g for i, g, _ in got if i == 21), next(g for i, g, _ in got if i == 22))
    assert {r.lang_pred for r in langid.identify(df, labelled.limit(0)).collect()} == {"und"}
    assert langid.identify(df.limit(0), labelled).count() == 0


def test_windows_cover_every_byte():
    data = bytes(range(1, 256)) * 5
    windows = langid.windows_of(data)
    assert b"".join(w[: langid.WINDOW].tobytes() for w in windows).rstrip(b"\0") == data
    assert (windows[0][langid.WINDOW :] == windows[1][: windows.shape[1] - langid.WINDOW]).all()


# pieces

MODEL = queries.tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(MODEL)


def library_ids(model, texts):
    from curbair.llm.words import WordTable

    flat, counts = WordTable(model.encode_words).ids([model.words(model.normal(t)) for t in texts])
    return [part.tolist() for part in np.split(flat, np.cumsum(counts)[:-1])]


def test_pieces_equal_the_library(model):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rng = random.Random(3)
    letters = "abcdeth  \n\t▁éñ日本12🙂́\0.,<0x>"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    texts += ["a" * 300, " " * 37, "the the", "", "aaaaabbbbaaa"]
    ids = library_ids(model, texts)
    assert ids == [library.encode(t) for t in texts]
    assert [model.decode(i) for i in ids] == [t.replace("▁", " ") for t in texts]


def test_unigram_scores_are_the_best_of_all_segmentations():
    from sentencepiece import sentencepiece_model_pb2 as schema

    proto = schema.ModelProto()
    with open(MODEL, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = 1
    rng = random.Random(1)
    for piece in proto.pieces:
        piece.score = -rng.uniform(1, 12) if piece.type == 1 else 0.0
    unigram = pieces.PieceModel(proto=proto.SerializeToString())

    def best(word):
        score = [0.0] + [-np.inf] * len(word)
        for end in range(1, len(word) + 1):
            for j in range(end):
                part = word[j:end]
                value = unigram.score.get(part, unigram._least if len(part) == 1 else -np.inf)
                score[end] = max(score[end], score[j] + value)
        return score[-1]

    words = sorted({"▁" + "".join(rng.choice("theinaor") for _ in range(rng.randint(1, 9))) for _ in range(300)})
    for word, parts in zip(words, unigram.segment(words), strict=True):
        assert "".join(parts) == word
        assert sum(unigram.score.get(p, unigram._least) for p in parts) == pytest.approx(best(word))


def test_piece_columns_and_digests(spark):
    rows = odd_texts()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"ids": F.lit("x"), "n_tokens": F.lit("y")})
    back = pieces.decode(pieces.encode(df, MODEL), MODEL).collect()
    assert [(r.decoded or "") for r in back] == [(r.text or "").replace("▁", " ") for r in back]
    digests = pieces.piece_digests(df, MODEL).collect()
    assert all(r.round_trip for r in digests) and len(digests) == len(rows)
    assert {(r.n_tokens, r.ids_crc32) for r in digests if r.doc_id in (1, 2)} == {(0, 0)}
    assert pieces.piece_digests(df.limit(0), MODEL).count() == 0


# token files

@pytest.mark.parametrize("values", [[], [5], [0, 0, 0], [-7, -7, 3, 10**12], list(range(0, 5000, 7)), [2**40] * 700])
def test_elias_fano_round_trip(values):
    coded, end = tokenfile.EliasFano.from_bytes(b"xx" + tokenfile.EliasFano.of(np.array(values, np.int64)).to_bytes(), 2)
    assert coded.values().tolist() == values and [coded.select(i) for i in range(len(values))] == values
    with pytest.raises(IndexError):
        coded.select(len(values))


def test_elias_fano_is_small():
    ends = np.cumsum(np.random.default_rng(0).integers(1, 1000, 50_000))
    assert len(tokenfile.EliasFano.of(ends).to_bytes()) < 50_000 * (2 + 10) / 8 + 2000


@pytest.mark.parametrize("file_ids", [tokenfile.FILE_IDS, 50])
def test_token_files_equal_the_library(spark, file_ids):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rows = odd_texts()[:8] + [(40 - i, t) for i, t in enumerate(
        ["été don't WE'VE <|endoftext|>x", "a\r\nb c d", "Ünï 12,5% ...", "ΣΑΣ ﬁ"])] + [(None, "no id"), (-5, "minus")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"part": F.lit(1), "start": F.lit(1)})
    got = sorted(((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in tokenfile.token_files(df, path, file_ids=file_ids).collect()))
    start, want = 0, []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((start, d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want
    assert tokenfile.token_files(df.limit(0), path).count() == 0


def test_token_file_reaches_one_document():
    lengths, ids = np.array([3, 1, 4]), np.arange(8, dtype=np.uint32) + 70_000
    held = tokenfile.TokenFile(tokenfile.pack([None, 4, 9], lengths, ids))
    assert (held.width, held.doc_id(0), held.doc_id(2)) == (4, None, 9)
    assert held.document(2).tolist() == ids[4:].tolist() and held.span(1) == (3, 4)


def test_tokenizers_that_keep_blanks_are_refused(spark):
    df = spark.createDataFrame([(1, "hello world again")], SCHEMA)
    with pytest.raises(ValueError, match="words"):
        tokenfile.token_files(df, queries.tokenizer_path("byte_bpe_50k.json"))


def test_select_over_long_gaps():
    rng = np.random.default_rng(1)
    for top in (3, 40, 10**5):
        values = np.cumsum(np.where(rng.random(3000) < 0.01, rng.integers(0, top * 500, 3000), rng.integers(0, top, 3000)))
        coded, _ = tokenfile.EliasFano.from_bytes(tokenfile.EliasFano.of(values).to_bytes(), 0)
        assert [coded.select(i) for i in range(3000)] == values.tolist()


# mixture

def test_raking_meets_the_targets_in_both_ways(spark):
    rng = random.Random(4)
    rows = [(i, "w " * rng.randint(1, 40), rng.choice("aab"), rng.choice("xyyz")) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    targets = {"source": {"a": 0.5, "b": 0.5}, "lang": {"x": 0.6, "y": 0.2, "z": 0.2}}
    margins = {"source": F.col("source"), "lang": F.col("lang")}
    here, spread = (mixture.mix(df, margins, targets, driver_cells=n).toPandas().sort_values("doc_id") for n in (100, 0))
    assert np.allclose(here.probability.values, spread.probability.values, atol=1e-7) and here.probability.max() == 1.0
    assert (here.kept.values == spread.kept.values).all()
    weight = here.tokens * here.probability
    for name, wanted in targets.items():
        share = weight.groupby(here[name]).sum() / weight.sum()
        assert share.to_dict() == pytest.approx(wanted, abs=1e-6)
    assert abs(here.kept.mean() - here.probability.mean()) < 0.06


def test_mixture_of_odd_rows(spark):
    rows = [(1, None, "a", None), (2, "", "a", "x"), (3, "one two", None, "x"), (4, "one", "b", "x"), (4, "one", "b", "x"), (None, "z z", "b", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").withColumn("tokens", F.lit("t"))
    margins = {"source": F.col("source"), "lang": F.col("lang")}
    found = mixture.mix(df, margins, 0.5)
    assert found.columns == ["doc_id", "text", "source", "lang", "tokens", "probability", "kept"]
    got = found.collect()
    assert len(got) == 6 and all(r.kept and r.tokens == 0 for r in got if r.doc_id in (1, 2))
    assert mixture.mix(df.limit(0), margins, 0.5).count() == 0
    gone = mixture.mix(df, margins, {"source": {"b": 1.0}, "lang": {"x": 1.0}}).filter("doc_id = 3").first()
    assert gone.probability == 0 and not gone.kept


@pytest.mark.parametrize("targets", [0.7, {"source": {"a": 0.4, None: 0.1}, "lang": {"x": 0.6, None: 0.2, "gone": 0.1}}])
def test_raking_spread_takes_null_margins(spark, monkeypatch, targets):
    rng = random.Random(9)
    rows = [(i, "w " * rng.randint(0, 9), rng.choice(["a", "a", "b", None]), rng.choice(["x", "y", "", None])) for i in range(300)]
    rows += [(300, None, "empty", None), (301, "", None, "none")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    margins = {"source": F.col("source"), "lang": F.col("lang")}
    here = mixture.mix(df, margins, targets).orderBy("doc_id").collect()
    monkeypatch.setattr(mixture, "tempered", None)  # collects the values
    spread = mixture.mix(df, margins, targets, driver_cells=0).orderBy("doc_id").collect()
    assert [(r.doc_id, r.source, r.lang, r.kept) for r in here] == [(r.doc_id, r.source, r.lang, r.kept) for r in spread]
    assert np.allclose([r.probability for r in here], [r.probability for r in spread], atol=1e-7)


# secrets

ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def brute_spans(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(spans)


def listed(spans):
    return ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def secret_texts():
    rng = random.Random(8)
    pieces = ["token=", "secret: ", "PassWord = '", "api_key\":\"", "APIKEY=", "abc", "AKIA", "AKIAABCDEFGHIJ1234", "0123456789abcdef",
              "deadbeef", " ", "é", "🙂", "=", "short", "averylongvalue123", "token=secret: abcdefghijklmnop", "\n", "K"]
    return [(i, "".join(rng.choice(pieces) for _ in range(rng.randint(0, 14)))) for i in range(400)]


def test_base_spans_equal_the_patterns(spark):
    rows = secret_texts() + [(1000, None), (1001, ""), (1002, "x " * 1000 + "0123456789abcdef " * 700)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"spans": F.lit(1), "base": F.lit(1), "id": F.lit(1)})
    found = {r.doc_id: r for r in secrets.scan_secrets(df).collect()}
    for i, text in rows:
        spans = brute_spans(text)
        assert found[i].base_sha256 == hashlib.sha256(listed(spans).encode()).hexdigest(), text
        assert [found[i].n_assign, found[i].n_access, found[i].n_hex] == [sum(k == n for _, k, _ in spans) for n in range(3)]
        all_spans = found[i].spans.split(",") if found[i].spans else []
        assert set(listed(spans).split(",")) - {""} <= set(all_spans)
        assert [s for s in all_spans if not s.startswith("random")] == [s for s in listed(spans).split(",") if s]
    assert secrets.scan_secrets(df.limit(0)).count() == 0


def test_battery_tells_random_strings_from_text(spark):
    rng = random.Random(1)
    alphabets = [e.alphabet for e in secrets.ENCODINGS if e.name in ("hex", "base62")]
    good = ["".join(rng.choice(a) for _ in range(40)) for a in alphabets for _ in range(100)]
    plain = ["aaaaaaaaaaaaaaaaaaaa1111111111111111bbbbbb", "version1234567890123456789012345thefirst", "deadbeefdeadbeefdeadbeefdeadbeef0",
             "Thisisalongidentifier2ofmanywords", "0123456789abcdef0123456789abcdef"] * 10
    words = ["Donaudampfschifffahrtsgesellschaft", "a-very-long-hyphenated-expression"]
    df = spark.createDataFrame([(i, f"é {w} y") for i, w in enumerate(good + plain + words)], SCHEMA)
    found = {r.doc_id: "random" in r.spans for r in secrets.scan_secrets(df).collect()}
    assert sum(found[i] for i in range(len(good))) >= 0.98 * len(good)
    assert not any(found[i] for i in range(len(good), len(found)))


def test_every_encoding_is_tested(spark):
    rng = random.Random(6)
    names = [e.name for e in secrets.ENCODINGS]
    forms = [(n, "") for n in names] + [("base36", "key-"), ("base36", "a_long-prefix_"), ("BASE36", "KEY_"), ("BASE36", "LICENCE-")]
    rows = []
    for name, before in forms * 40:
        alphabet = next(e.alphabet for e in secrets.ENCODINGS if e.name == name)
        rows.append((len(rows), f"é {before}{''.join(rng.choice(alphabet) for _ in range(40))} y"))
    rows += [(len(rows), "é K7Q09XJ2M5N8B1V4C6Z3L0P9D8 y"), (len(rows) + 1, "é key-3ax6xnjp29jd6fds4gc373sgvjxteol0 y")]
    plain = ["AAAAAAAAAAAAAAAABBBBBBBBBBBBBBBB0011", "a-very-long-hyphenated-expression-of-2024", "XXXXXXXXYYYYYYYYZZZZZZZZ00000011111"]
    rows += [(len(rows) + i, t) for i, t in enumerate(plain * 10)]
    found = {r.doc_id: "random" in r.spans for r in secrets.scan_secrets(spark.createDataFrame(rows, SCHEMA)).collect()}
    for k, form in enumerate(forms):
        assert sum(found[i] for i in range(k, 40 * len(forms), len(forms))) >= 38, form
    n = 40 * len(forms)
    assert found[n] and found[n + 1] and not any(found[i] for i in range(n + 2, len(rows)))


def test_what_stands_beside_a_secret_does_not_hide_it(spark):
    rng = random.Random(5)
    draw = lambda name, n: "".join(rng.choice(next(e.alphabet for e in secrets.ENCODINGS if e.name == name)) for _ in range(n))
    forms = [("AWS_SECRET_ACCESS_KEY=", "base62", ""), ("https://a.b/c?sig=", "base62", "&x=1"), ("/users/sk_live_", "base62", ""),
             ("a=b=", "base64", "==;"), ("cfg_some_long_name-", "base64", ""), ("/files/of/somebody/", "base64url", "/raw_text"),
             ("/api/version/accounts/keys/of_", "base62", "/show"), ("x_of_the_", "base62", "/and/more/text/here")]
    rows, want = [], []
    for before, name, after in forms * 25:
        key = draw(name, 44)
        rows.append((len(rows), f"é {before}{key}{after} y"))
        want.append((key, 2 + len(before), 46 + len(before) + 2 * after.startswith("==")))
    plain = ["/users/of/the_application/with-some-long/path1/name_2/index", "a=b=c=d=e=f=g=h=i=j=k=l=m=n", "=" * 40,
             "DEFAULT_CONNECTION_TIMEOUT_SECONDS=30", "key=aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa1B/_"]
    rows += [(len(rows) + i, t) for i, t in enumerate(plain)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = {r.doc_id: [tuple(map(int, s.split(":")[1:])) for s in r.spans.split(",") if s.startswith("random")]
             for r in secrets.scan_secrets(df).collect()}
    for k in range(len(forms)):
        hit = [any(a <= s and e <= b for a, b in found[i]) for i, (_, s, e) in enumerate(want) if i % len(forms) == k]
        assert sum(hit) >= 23, forms[k]
    assert not any(found[i] for i in range(len(want), len(rows)))
    for spans in found.values():
        assert not any(a <= c and d <= b for i, (a, b) in enumerate(spans) for j, (c, d) in enumerate(spans) if i != j)
    clean = {r.doc_id: r.text for r in secrets.redact(df).collect()}
    assert all((key in clean[i]) != any(a <= s and e <= b for a, b in found[i]) for i, (key, s, e) in enumerate(want))


def test_scan_is_native(spark):
    from conftest import plan_of

    plan = plan_of(secrets.scan_secrets(spark.createDataFrame(secret_texts(), SCHEMA)))
    assert not re.search("Python|Pandas|Arrow", plan)


def test_redaction_leaves_no_base_span(spark):
    rows = secret_texts() + [(1000, None)]
    clean = {r.doc_id: r.text for r in secrets.redact(spark.createDataFrame(rows, SCHEMA)).collect()}
    for i, text in rows:
        spans = brute_spans(text)
        if not spans and "random" not in (clean[i] or ""):
            assert clean[i] == text or "[secret]" in clean[i]
        for a, _, b in spans:
            assert text[a:b] not in clean[i]
    assert clean[1000] is None
