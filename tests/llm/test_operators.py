"""Each corpus operator against a plain version or a round trip, on a small table of awkward rows."""

from __future__ import annotations

import base64
import hashlib
import itertools
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from pyspark.sql import functions as F
from tallyworks.llm import bytebpe, fingerprints, jaccard, language, licenses, linededup, packing, pii, topk, toxicity

LONG = " ".join(f"word{i % 977}x{i % 13}" for i in range(180_000))  # beyond one slice
BASE = " ".join(f"t{i}" for i in range(300))
ROWS = [
    (1, "Hello there, this is a small text. It's fine!", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, "b"),
    (4, "   \n\n\t ", "en", "b"),
    (5, LONG, "en", "a"),
    (6, BASE, "en", "a"),
    (7, BASE, "en", "a"),
    (8, BASE + " extra words at the end", "en", "c"),
    (9, BASE.replace("t7 ", "u7 ").replace("t250 ", "u250 "), "en", "c"),
    (10, "one two three", "en", "c"),
    (11, "ONE two\nthree", "en", "c"),
    (12, "Ünïcödé 你好 🙂🙂 naïve café   x  y", "fr", "c"),
    (13, "x" * 3000, "en", None),
    (14, "mail me: a.b@c.example.org, 10.0.0.1 or +1 (212) 555-0147, card 4111 1111 1111 1111.", "en", "a"),
    (14, "mail me: a.b@c.example.org, 10.0.0.1 or +1 (212) 555-0147, card 4111 1111 1111 1111.", "en", "a"),
    (15, "l1\nl2\nl3\nl4\nl5", "en", "a"),
    (16, "zz\nl1\nl2\nl3\nl4\nqq", "en", "a"),
    (17, "l2\nl3\nl4\nl2\nl3\nl4", "en", "a"),
    (18, "Released under the MIT License.\nLicensed under CC BY-NC 4.0!", "en", "a"),
]


@pytest.fixture(scope="module")
def docs(spark):
    """The rows with extra columns whose names clash with those the operators use inside."""
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    return df.withColumns({n: F.lit(7) for n in ("cls", "n", "key", "score", "place", "piece", "lines", "words", "ids", "range", "label", "removed_lines")}).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("doc_id < 0")


def texts():
    return [(i, t or "") for i, t, *_ in ROWS]


def test_toxicity_learns_gapped_insults(spark):
    rng = np.random.default_rng(1)
    parts = "the and of to is in ation ere ing tion for with en on at".split()
    plain = lambda: " ".join("".join(rng.choice(parts, 2)) for _ in range(30))
    rows = [(plain() + f" {rng.choice(['zquark', 'plumbo'])} " + plain(), 1) for _ in range(60)] + [(plain(), 0) for _ in range(140)]
    model = toxicity.train(rows)
    assert toxicity.train([("a b", 1), ("c d", 1)]) is None
    tests = [plain() + " zquark " + plain(), plain() + " z q u a r k " + plain(), plain() + " zquaark " + plain(), plain(), "", None, plain() + LONG]
    df = spark.createDataFrame(list(enumerate(tests)), "doc_id long, text string")
    got = {r["doc_id"]: r["s"]["score"] for r in df.select("doc_id", toxicity.scorer(df, model)(F.col("text")).alias("s")).collect()}
    assert min(got[0], got[1]) >= 0.7 and got[2] > got[3] and max(got[3], got[4], got[5]) < 0.5
    assert got[4] == got[5] and all(0 <= s <= 1 for s in got.values())
    # the folded table gives the kernel's own values
    unit = "^zquark"
    codes, values = toxicity._features(toxicity._padded([unit]))
    assert model.margins([unit])[0] == pytest.approx(max(0, float((model.weight[codes] * values).sum()) + model.bias), abs=1e-5)


def test_toxicity_without_labels(docs, spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert model is None
    assert {r["s"]["score"] for r in docs.select(toxicity.scorer(docs, model)(F.col("text")).alias("s")).collect()} == {0.0}


def test_licenses(docs, none):
    got = {(r["doc_id"], r["license"]): (r["dice"], r["lines"]) for r in licenses.scan(docs).collect()}
    assert got == {(18, "MIT"): (1.0, 1), (18, "CC-BY-NC-4.0"): (1.0, 1)}
    assert licenses.scan(none).count() == 0
    plan = licenses.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_licenses_over_lines(spark):
    """Notices wrapped over lines, with signs and empty lines between; lines beside them do not count."""
    mit = next(t for name, t in licenses.TEMPLATES if name == "MIT" and len(t) > 50).split()
    apache = max((t for name, t in licenses.TEMPLATES if name == "Apache-2.0"), key=len).split()
    bsd = next(t for name, t in licenses.TEMPLATES if name == "BSD-3-Clause").split()
    rows = [
        (1, "some code\n# " + "\n#\n# ".join(" ".join(mit[k : k + 7]) for k in range(0, len(mit), 7)) + "\nmore code"),
        (2, " ".join(apache[:11]) + "\n" + " ".join(apache[11:])),
        (3, "\n".join(bsd)),
        (4, "Released under the MIT License.\nReleased under the MIT License\nof it"),
        (None, "x\nLicensed under\nCC BY 4.0."),
        (5, "permission software\nlicense restriction"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["license"]): (r["dice"], r["lines"]) for r in licenses.scan(df).collect()}
    assert got == {
        (1, "MIT"): (1.0, -(-len(mit) // 7)), (2, "Apache-2.0"): (1.0, 2), (3, "BSD-3-Clause"): (1.0, len(bsd)),
        (4, "MIT"): (1.0, 2), (None, "CC-BY-4.0"): (1.0, 2),
    }


def test_pii_base_and_added():
    text = ROWS[13][1]
    base, every = pii.spans_of([text])[0]
    assert [k for k, *_ in base] == ["email", "ip", "card", "phone"] and set(base) <= set(every)
    assert "555" not in pii.redacted(text, every) and "@" not in pii.redacted(text, every)
    (none, added), (_, clean) = pii.spans_of(["please call (020) 555-7713 after lunch", "founded in 1987, see pages 12-15 of version 2.0"])
    assert not none and [k for k, *_ in added] == ["phone"] and not clean
    assert pii.spans_of([None, ""]) == [([], []), ([], [])]


@pytest.mark.parametrize("text", ["a@b.c.d e@f", "a@@b.cc x.y@z-1.q@r.s", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.255", "4111-1111 1111-1111 4", "+1 23 45 67 89 +1((((2", "+12345678+12345678", "1" * 5000 + ".1.1.1", ".@a.b"])
def test_pii_patterns(text):
    def plain():
        for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
            yield "email", *m.span()
        for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
            if all(len(p) < 100 and int(p) <= 255 for p in m.group().split(".")):
                yield "ip", *m.span()
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
            d = re.sub("[ -]", "", m.group())
            if 16 <= len(d) <= 19 and pii.luhn(d):
                yield "card", *m.span()
        for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
            if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
                yield "phone", *m.span()

    assert pii.base_spans(text) == list(plain())


def test_viterbi_is_the_best_path():
    field, words = pii.field(), "call (020) 555-7713 12".split()
    run = [pii._features(words, i) for i in range(1, 4)]
    move, n = field._moves(), len(pii.LABELS)
    emit = [field.emit[[field.index[f] for f in fs if f in field.index]].sum(0) for fs in run]
    best = max(itertools.product(range(n), repeat=3), key=lambda p: move[n, p[0]] + sum(e[x] for e, x in zip(emit, p)) + move[p[0], p[1]] + move[p[1], p[2]])
    assert tuple(field.decode([run])[0]) == best


@pytest.mark.parametrize("lead", ["", "7 "])
def test_pii_runs_are_decoded_whole(lead):
    """A span is found as one wherever it lies in a long run, as by one pass over the whole run."""
    text = lead + "(020) 555-7713\n" * 400
    field, words = pii.field(), text.split()
    move, n = field._moves(), len(pii.LABELS)
    emit = [field.emit[[field.index[f] for f in pii._features(words, i) if f in field.index]].sum(0) for i in range(len(words))]
    best, came = move[n] + emit[0], []
    for e in emit[1:]:
        through = best[:, None] + move[:n]
        came.append(through.argmax(0))
        best = through.max(0) + e
    path = [int(best.argmax())]
    for c in reversed(came):
        path.append(int(c[path[-1]]))
    (run,) = pii._runs(text)
    assert field.decode([run])[0].tolist() == path[::-1]
    (_, every), = pii.spans_of([text])
    assert len(every) == sum(pii.LABELS[k].startswith("B") for k in path)


def test_fingerprints(docs, none):
    got = fingerprints.fingerprints(docs).collect()
    ordered = sorted(texts())
    assert len(got) == len(ROWS)
    want = {}
    for k, (i, t) in enumerate(ordered):
        moved = len(t) // 4
        edited = t[: len(t) - moved] + ordered[(k + 1) % len(ordered)][1][:moved]
        want.setdefault(i, set()).add(hashlib.sha256(edited.encode()).hexdigest())
    assert all(r["edited_sha256"] in want[r["doc_id"]] for r in got)
    by = {r["doc_id"]: r for r in got}
    assert by[6]["fingerprint"] == by[7]["fingerprint"] and by[6]["near_next"] == 1.0
    assert by[2]["fingerprint"] == by[3]["fingerprint"] == "" and by[2]["near_next"] == 1.0
    assert by[5]["near_edited"] > 0.3 > by[5]["near_next"]
    assert fingerprints.fingerprints(none).count() == 0
    codes = np.frombuffer(BASE.encode("utf-32-le"), np.uint32)
    small = fingerprints._rolling(codes.astype(np.uint64), fingerprints.S)
    inner = fingerprints.K - fingerprints.S + 1
    plain = [i for i in range(len(codes) - fingerprints.K + 1) if min(small[i : i + inner]) in (small[i], small[i + inner - 1])]
    assert fingerprints.anchors(codes)[0].tolist() == plain


def test_likeness_of_short_texts_is_that_of_their_anchors():
    """Below KEEP anchors nothing is cut off: the share of all united anchors in one order."""
    a, b = [(h, h) for h in range(0, 24)], [(h, h + 3) for h in range(10, 34)]
    assert fingerprints.likeness(a, b) == fingerprints.likeness(b, a) == 14 / 34
    assert fingerprints.likeness(a, a) == 1.0 and fingerprints.likeness(a, []) == 0.0 and fingerprints.likeness([], []) == 1.0
    backwards = [(h, 100 - h) for h in range(0, 24)]
    assert fingerprints.likeness(a, backwards) == 1 / 24
    many, other = [(h, h) for h in range(0, 128, 2)], [(h, h) for h in range(0, 192, 3)]
    united = sorted({h for h, _ in many} | {h for h, _ in other})[: fingerprints.KEEP]
    assert fingerprints.likeness(many, other) == sum(h % 6 == 0 for h in united) / fingerprints.KEEP


def test_language(docs, none):
    rows = [("en", "the house and the garden of them " * 20), ("fr", "la maison et le jardin des voisins " * 20)]
    model = language.train(rows)
    assert language.train([]) is None
    got = {r["doc_id"]: r["l"] for r in docs.select("doc_id", language.detect(docs, F.col("text"), model).alias("l")).collect()}
    assert language.code_lengths(model, b"the garden of them").argmin() == 0 and all(got[i]["lang_pred"] == "und" for i in (2, 3, 4))
    assert language.code_lengths(model, b"le jardin").argmin() == 1
    # exact: probabilities of all followers of any context sum to at most one, and a text's cost is the sum of its bytes'
    assert (np.exp2(-model.bits.astype(float)).sum(1) < 1 + 1e-3).all()
    size = model.bits.shape[1]
    classes = [model.byte_class[32]] * 3 + [model.byte_class[b] for b in b"the fool"]
    total = sum(model.bits[model.row_of[(a * size + b) * size + c], d] for a, b, c, d in zip(classes, classes[1:], classes[2:], classes[3:]))
    assert np.allclose(total, language.code_lengths(model, b"the fool"), rtol=1e-4)
    assert none.select(language.detect(none, F.col("text"), None)).count() == 0


def test_language_learns_from_long_texts_alone(spark):
    """A language all of whose texts are long is learned from stretches of them."""
    long = "la maison et le jardin des voisins " * 900
    rows = [(1, "the house and the garden of them " * 20, "en"), (2, long, "fr"), (3, long[5:], "fr"), (4, None, "de"), (5, "", "de"), (6, "x", None)]
    taken = language.sample(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert sorted((lang, len(t)) for lang, t in taken) == [("de", 0), ("en", 660), ("fr", 20_000), ("fr", 20_000)]
    assert all(t in long for lang, t in taken if lang == "fr")
    assert language.code_lengths(language.train(taken), b"le jardin des").argmin() == 2


def test_top_k(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8) * (rng.random(8) < 0.6)]) for i in range(300)]
    rows += [(400, None), (401, [1.0, None] + [0.0] * 6), (402, [float("nan")] * 8), (403, []), (404, rows[7][1]), (7, rows[7][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    got = {}
    for r in topk.top_k(df, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    w = {i: np.floor(256 * np.array(x, np.float32).astype(float)).astype(int) for i, x in rows if x and all(v is not None and v == v for v in x)}
    for q in (i for i in w if i % 50 == 0):
        want = sorted(((int(w[q] @ x), i) for i, x in w.items() if i != q), key=lambda x: (-x[0], x[1]))[:5]
        assert [got[q][k] for k in range(1, 6)] == [(i, s) for s, i in want]
    assert topk.top_k(df.where("vec_id < 0"), F.col("vec_id") % 50 == 0).count() == 0
    assert topk.top_k(df.where("vec_id in (0, 1)"), F.col("vec_id") % 50 == 0).count() == 1
    large = spark.createDataFrame([(0, [2.0**22, 1.0]), (1, [2.0**22, -1.0])], "vec_id long, embedding array<float>")
    assert [r["score"] for r in topk.top_k(large, F.col("vec_id") == 0).collect()] == [2**60 - 2**16]
    with pytest.raises(Exception, match="may not fit a 64-bit score"):
        topk.top_k(large.withColumn("embedding", F.transform("embedding", lambda x: x * 1024)), F.col("vec_id") == 0).collect()


def test_packing(docs, none):
    path = public_tokenizers.path("word_bpe_49k.json")
    pieces = packing.token_pieces(docs, path).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("crc"))
    got = packing.pack(pieces, group_rows=5, documents=len(ROWS)).toPandas()
    tokenizer, want = Tokenizer.from_file(path), []
    for i, t in texts():
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4")
        want += [(i, k, s, len(ids[s : s + 2048]), zlib.crc32(ids[s : s + 2048].tobytes())) for k, s in enumerate(range(0, len(ids), 2048))]
    assert sorted(zip(got.doc_id, got.piece, got.start, got.length, got.crc)) == sorted(want)
    for _, g in got.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *g.length.cumsum().tolist()[:-1]] and g.length.sum() <= 2048
    assert packing.pack(packing.token_pieces(none, path).drop("ids")).count() == 0


def test_best_two_fit_replaces_the_smallest():
    bins, offsets = packing.best_two_fit(np.array([60, 35, 22, 20, 15, 15]), 100)
    full = np.bincount(bins, np.array([60, 35, 22, 20, 15, 15]))
    assert full.max() <= 100 and (bins >= 0).all()
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 2048, 3000)
    bins, offsets = packing.best_two_fit(sizes)
    assert np.bincount(bins, sizes).max() <= 2048 and bins.max() + 1 <= 1.02 * sizes.sum() / 2048 + 1


def test_byte_bpe(docs, none):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    public = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r["doc_id"]: r for r in bytebpe.round_trip(docs, path, public_tokenizers.PATTERN).collect()}
    for i, t in texts():
        ids = public.encode_ordinary(t)
        assert got[i]["n_tokens"] == len(ids) and got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(t.encode()).hexdigest()
    assert bytebpe.round_trip(none, path, public_tokenizers.PATTERN).count() == 0
    encoder, rng = bytebpe.Encoder(ranks, public_tokenizers.PATTERN), np.random.default_rng(5)
    alphabet = list("aabbtheinoé \n\x1c\xa0'!1你́ ")
    for _ in range(300):
        t = "".join(rng.choice(alphabet, rng.integers(1, 40)))
        assert [i for _, ids in encoder.encode_batch([t]) for i in ids.tolist()] == public.encode_ordinary(t), repr(t)
        data = t.encode()
        assert encoder.transducer.simulated(data) == [ranks[p] for p in encoder.transducer.merged(data)]


@pytest.mark.parametrize("data", ["aé你🙂".encode(), b"\xff\xfea", b"\xe4\xbd", b"\xf0\x9f\x99a\x80", b"\xed\xa0\x80", b"\xc0\xaf\xe0\x80\x80"])
def test_utf8_machine(data):
    for cut in range(len(data) + 1):
        machine = bytebpe.Utf8()
        assert machine.feed(data[:cut]) + machine.feed(data[cut:]) + machine.close() == data.decode("utf-8", "replace")


def _plain_components(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", t.encode().lower())
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    label = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
    return sets, label


def test_jaccard_join(docs, none, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 2)  # so that groups have several blocks
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(docs).collect()}
    sets, label = _plain_components(texts())
    assert got == {i: (len(sets[i]), label[i]) for i in sets}
    assert got == {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(docs, most=1).collect()}
    assert jaccard.near_duplicates(none).count() == 0


def test_jaccard_blocks_drawn_anew_are_compared_within(spark, monkeypatch):
    """One large family gets blocks of its own, so the pairs beside it share fewer blocks than before."""
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    rng = np.random.default_rng(5)
    family = rng.choice(1 << 62, 100, replace=False).astype(np.uint64)
    sets = [np.append(family, rng.integers(0, 1 << 62, 1).astype(np.uint64)) for _ in range(60)]
    for _ in range(2):
        own = rng.choice(1 << 62, 100, replace=False).astype(np.uint64)
        sets += [np.append(own, np.uint64(k)) for k in (1, 2)]
    sets = [np.unique(s) for s in sets]
    rows = [(i + 1, len(s), bytearray(jaccard.bit_sketch(s).tobytes()), bytearray(s.tobytes())) for i, s in enumerate(sets)]
    payload = spark.createDataFrame(rows, "cls long, n long, sketch binary, shingles binary")
    groups = payload.select(F.lit(7).cast("long").alias("grp"), "cls", F.lit(len(rows)).cast("long").alias("count"))
    for exact in (True, False):
        label = {r["cls"]: r["label"] for r in jaccard.linked(groups, payload, exact).collect()}
        assert len({label[i] for i in range(1, 61)}) == 1
        assert [label[i] == label[i + 1] for i in range(61, 65, 2)] == [True] * 2
        assert len(set(label.values())) == 3


def test_word_hashes(monkeypatch):
    pieces = [b"one two  one", b"", b" \x0b", b"two " + b"x" * 50, b"\xe4\xbd\xa0 one"]
    short = [h.tolist() for h in jaccard.word_hashes(pieces)]
    assert short[0][0] == short[0][2] == short[4][1] and short[0][1] == short[3][0] and short[1] == short[2] == []
    assert len({h for hs in short for h in hs}) == 4
    monkeypatch.setattr(jaccard, "LONGEST", 8)  # word by word, in parts
    assert [h.tolist() for h in jaccard.word_hashes(pieces)] == short


def test_jaccard_join_keys_lose_no_link():
    rng = np.random.default_rng(2)
    for n in [*range(1, 40), 100, 333, 1000]:
        for _ in range(8):
            a = rng.choice(1 << 62, n, replace=False).astype(np.uint64)
            gone = rng.integers(0, n // 5 + 1)
            new = rng.choice(1 << 62, rng.integers(0, n // 5 + 1), replace=False).astype(np.uint64)
            b = np.concatenate([a[gone:], new])
            a, b = np.unique(a), np.unique(b)
            common = len(np.intersect1d(a, b))
            far = np.bitwise_count(jaccard.folded(jaccard.bit_sketch(a), 1) ^ jaccard.folded(jaccard.bit_sketch(b), 1)).sum()
            assert far <= len(a) + len(b) - 2 * common
            if common and 5 * common >= 4 * (len(a) + len(b) - common) and len(a) + len(b) > 2 * common:
                assert len(np.intersect1d(jaccard.keys_of(a)[0], jaccard.keys_of(b)[0])), (len(a), len(b), common)


def test_line_dedup(docs, none):
    kept = {r["doc_id"]: (r["text"], r["r"]) for r in linededup.without_repeats(docs.drop("removed_lines")).withColumnRenamed("removed_lines", "r").collect()}
    seen, want = set(), {}
    for i, t, *_ in sorted(set(ROWS), key=lambda r: r[0]):
        lines = (t or "").split("\n")
        covered = set()
        for k in range(len(lines) - 2):
            w = tuple(lines[k : k + 3])
            covered |= {k, k + 1, k + 2} if w in seen else set()
            seen.add(w)
        want[i] = (t if not covered else "\n".join(x for k, x in enumerate(lines) if k not in covered), len(covered))
    assert kept == want and kept[17][1] == 6 and kept[2][0] is None
    assert linededup.without_repeats(none).count() == 0


def test_line_dedup_tells_rows_of_one_id_apart(spark):
    """Rows without an id, and different texts under one id, are documents of their own."""
    rows = [
        (None, "a1\na2\na3\nown 1"),
        (None, "p\nq\nr\ns\nt\nu\na1\na2\na3\nown 2"),
        (None, "a1\na2\na3\nown 3"),  # the same window at the same place
        (5, "b1\nb2\nb3"),
        (5, "only here"),
        (5, "c\nd\ne\nf\nb1\nb2\nb3\nown 5"),
        (6, "a2\na3\nown 3\nb1\nb2\nb3\nown 6"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    order = df.orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).collect()
    seen, want = set(), []
    for i, t in order:
        lines = t.split("\n")
        covered = set()
        for k in range(len(lines) - 2):
            w = tuple(lines[k : k + 3])
            covered |= {k, k + 1, k + 2} if w in seen else set()
            seen.add(w)
        want.append((i, "\n".join(x for k, x in enumerate(lines) if k not in covered), len(covered)))
    got = [tuple(r) for r in linededup.without_repeats(df).select("doc_id", "text", "removed_lines").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(t.count("a1") for _, t, _ in got) == sum(t.count("b1") for _, t, _ in got) == 1
