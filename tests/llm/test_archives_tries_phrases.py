"""Archives, prefix tries and collocations against plain versions, on small tables of awkward rows."""

from __future__ import annotations

import gzip
import hashlib
import random
import re
import uuid
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tallyworks.llm import collocations, prefixtrie, warc
from tallyworks.llm.text import fresh_folder

# Archives

BIG = "<html>" + "same page " * 200 + "</html>"
INNER = (
    "x" * 1200 + "\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:uuid:fake>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\nWARC/1.0\r\n"
)
PAGES = [
    (1, "http://a.example/x?y=1", BIG),
    (2, "http://a.example/z", BIG),
    (3, None, BIG),
    (3, None, BIG),
    (4, "http://b.example", INNER),
    (5, "http://b.example/\r\nEvil: 1", INNER),
    (6, "http://c.example/", "WARC/1.0\r\n"),
    (7, "", ""),
    (8, "http://d.example/", None),
    (8, "http://d.example/", None),
    (None, "http://e.example/", "y" * 999 + "é"),
    (None, "http://e.example/", "y" * 999 + "é"),
    (9, "http://f.example/", "short twice"),
    (10, "http://f.example/", "short twice"),
    (11, "http://g.example/", "\r\n\r\n" * 400),
    (12, "http://h.example/", "Z" * 3_000_000),
] + [(100 + i, f"http://copies.example/{i}", "copy " * 300) for i in range(60)]


@pytest.fixture(scope="module")
def pages(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    return df.withColumns({n: F.lit(7) for n in ("digest", "bytes", "payload", "n", "salt", "copy", "top", "record", "response")}).repartition(5)


@pytest.fixture(scope="module")
def archive(spark, pages):
    path = fresh_folder(spark, "warc")
    warc.write_archives(pages, path)
    return path


def plain_catalogue():
    groups = defaultdict(list)
    out = []
    for page, url, html in PAGES:
        groups[(html or "").encode()].append((page, url or ""))
    for payload, members in groups.items():
        members.sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1]), reverse=True)
        for place, (page, _) in enumerate(members):
            again = len(payload) >= 1000 and place > 0
            kind, first = ("revisit", members[0][0]) if again else ("response", None)
            out.append((page, len(payload), hashlib.sha1(payload).hexdigest(), kind, first))
    return Counter(out)


def test_archives_give_back_every_capture(spark, archive):
    found = warc.catalogue(warc.read_records(spark, archive)).drop("target_uri")
    assert Counter(tuple(r) for r in found.collect()) == plain_catalogue()


def test_archives_are_plain_warc(archive):
    """Read by the rules alone: version, fields, and as many bytes as Content-Length says."""
    from pathlib import Path

    kinds, payloads = Counter(), []
    for file in Path(archive.removeprefix("file://")).glob("*.gz"):
        data = gzip.decompress(file.read_bytes())
        while data:
            head, _, rest = data.partition(b"\r\n\r\n")
            lines = head.decode().split("\r\n")
            assert lines[0] == "WARC/1.0"
            fields = dict(line.split(": ", 1) for line in lines[1:])
            size = int(fields["Content-Length"])
            assert rest[size : size + 4] == b"\r\n\r\n"
            kinds[fields["WARC-Type"]] += 1
            if fields["WARC-Type"] == "response":
                payloads.append(rest[:size].split(b"\r\n\r\n", 1)[1].decode())
            data = rest[size + 4 :]
    want = plain_catalogue()
    assert kinds["request"] == kinds["metadata"] == len(PAGES) == kinds["response"] + kinds["revisit"]
    assert Counter(map(len, payloads)) == Counter(len((h or "")) for h, n in responses().items() for _ in range(n))
    assert kinds["revisit"] == sum(n for r, n in want.items() if r[3] == "revisit")


def responses():
    texts = Counter((h or "") for _, _, h in PAGES)
    return {t: 1 if len(t.encode()) >= 1000 else n for t, n in texts.items()}


def test_nested_captures(spark, archive, pages):
    rows = warc.captures(warc.read_records(spark, archive)).collect()
    assert len(rows) == len(PAGES)
    assert all(r.response.whole and len(r.requests) == len(r.metadata) == 1 for r in rows)
    assert all(r.requests[0].http_headers.startswith("GET ") for r in rows)
    assert {r.response.target_uri for r in rows if "Evil" in r.response.target_uri} == {"http://b.example/%0D%0AEvil: 1"}
    assert sorted(bytes(r.response.payload).decode() for r in rows if r.response.record_type == "response") == sorted(
        t for t, n in responses().items() for _ in range(n)
    )


def test_foreign_archives(spark, tmp_path):
    """Members gzipped one by one, links the other way round, a record cut short, and one that names no response."""

    def record(kind, own, block, *more):
        head = "\r\n".join(["WARC/1.0", f"warc-type: {kind}", f"WARC-RECORD-ID:  <{own}>", *more, f"Content-Length: {len(block)}"])
        return head.encode() + b"\r\n\r\n" + block + b"\r\n\r\n"

    body = b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n\x00\xff\xfeWARC/1.0\r\n tail"
    http = "Content-Type: application/http; msgtype=response"
    first = [
        record("warcinfo", "i", b"software: x\r\n"),
        record("request", "q", b"GET / HTTP/1.1\r\n\r\n", "Content-Type: application/http"),
        record("response", "r", body, http, "WARC-Concurrent-To: <q>"),
        record("metadata", "m", b"a: 1", "WARC-Concurrent-To: <r>", "WARC-Concurrent-To: <gone>"),
    ]
    (tmp_path / "one.warc.gz").write_bytes(b"".join(map(gzip.compress, first)))
    (tmp_path / "two.warc.gz").write_bytes(gzip.compress(record("response", "s", body, http)[:-20]))
    (tmp_path / "three.warc.gz").write_bytes(gzip.compress(record("response", "t", b"", http)))
    (tmp_path / "four.warc.gz").write_bytes(gzip.compress(b""))
    records = {r.record_id: r for r in warc.read_records(spark, str(tmp_path)).collect()}
    assert set(records) == {"<i>", "<q>", "<r>", "<m>", "<s>", "<t>"}
    assert records["<r>"].payload == b"\x00\xff\xfeWARC/1.0\r\n tail" and records["<r>"].whole
    assert not records["<s>"].whole and records["<t>"].whole and records["<t>"].payload == b""
    rows = {r.capture_id: r for r in warc.captures(warc.read_records(spark, str(tmp_path))).collect()}
    assert set(rows) == {"<r>", "<s>", "<t>", "<gone>"}
    assert [r.record_id for r in rows["<r>"].requests] == ["<q>"] and [r.record_id for r in rows["<r>"].metadata] == ["<m>"]
    assert rows["<gone>"].response is None and rows["<s>"].requests == [] == rows["<s>"].metadata


def test_archive_of_nothing(spark, pages):
    path = fresh_folder(spark, "warc")
    warc.write_archives(pages.where("page_id < 0"), path)
    assert warc.catalogue(warc.read_records(spark, path)).count() == 0


# Prefix tries


def awkward_conversations():
    rng = random.Random(5)
    rows = []
    for c in [*range(0, 130), 40_001, -3, -20, 2**40]:
        for t in range(rng.choice([0, 1, 1, 2, 3, 5, 9])):
            rows.append((c, t, rng.choice(["user", "assistant", None, ""]), rng.choice(["hello there", "yes", "", None, "two  words\n", "\x0b", "é"])))
    rows += [(7, None, "system", "be kind"), (7, None, "user", "again"), (8, 0, "user", "hello there"), (8, 0, "user", "hello there")]
    rows += [(None, 0, "user", "nobody"), (None, None, None, None)]
    rows += [(500, t, "user", f"turn {t}") for t in range(400)] + [(520, t, "user", f"turn {t}") for t in range(390)]
    rows += [(c, 0, "user", "the same opening") for c in range(600, 700)]
    rng.shuffle(rows)
    return rows


def plain_nodes(rows):
    def key(row):
        role, text = row[2] or "", row[3] or ""
        return (row[1] is not None, row[1] or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest())

    own = defaultdict(list)
    for row in sorted((r for r in rows if r[0] is not None), key=key):
        own[row[0]].append((row[2] or "", row[3] or ""))
    members, ends = defaultdict(set), defaultdict(list)
    members[()] = set()
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        path = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            members[path[:d]].add(c)
        ends[path].append(c)
    kids, leaves, saved = Counter(), Counter(), Counter()
    for path in members:
        if path:
            kids[path[:-1]] += 1
    for path, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += not kids[path]
            saved[path[:d]] += (len(m) - 1) * words
    return Counter(
        (min(m, default=None), len(p), min(members[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, m in members.items()
    )


TRIE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie_of(df, **how):
    nodes = prefixtrie.prefix_nodes(prefixtrie.regrown(prefixtrie.conversations(df)), **how)
    return Counter(tuple(r) for r in nodes.select(*TRIE).collect())


@pytest.mark.parametrize("most", [3, 4096])
def test_prefix_trie(spark, most):
    """Many small shards add up to what few large ones do."""
    rows = awkward_conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumns({n: F.lit(1) for n in ("turns", "h", "node", "words", "depth", "shard")}).repartition(3)
    assert trie_of(df, most=most) == plain_nodes(rows)


def test_trie_of_nothing(spark):
    df = spark.createDataFrame([(None, 1, "user", "x")], "conv_id long, turn long, role string, text string")
    empty = hashlib.sha256(b"").hexdigest()
    for rows in (df, df.where("turn < 0")):
        assert trie_of(rows) == Counter([(None, 0, None, 0, 0, 1, 0, empty)])


# Collocations


def awkward_texts():
    rng = random.Random(9)
    words = ["the", "The", "cat", "sat", "on", "a", "mat", "É", "\x00", "x\x1cy", "-"]
    gaps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b", "!"]
    out = []
    for i in range(60):
        text = "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.choice([0, 1, 3, 60])))
        out.append((i, text, rng.choice(["en", "und", None, "de"])))
    out += [(1, None, "en"), (1, None, None), (None, "new york city hall " * 40, "fr"), (70, "new york city hall", "fr"), (70, "new york city hall", "fr")]
    out += [(71, "new york, city hall. york new " * 3, "fr"), (72, "", "xx")]
    return out


def plain_collocations(rows, least, top):
    f, total = Counter(), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i : i + k])] += 1
    out = []
    candidates = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    for (lang, p), a in candidates.items():
        if any(la == lang and len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for (la, q), b in candidates.items()):
            continue
        score, _, left, right = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
        out.append((lang, " ".join(p), a, left, right, total[lang], score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    ranked, place = [], Counter()
    for r in out:
        place[r[0]] += 1
        if place[r[0]] <= top:
            ranked.append((r[0], place[r[0]], *r[1:]))
    return ranked


@pytest.mark.parametrize(("least", "top", "bits"), [(30, 2000, 27), (3, 7, 20), (1, 2000, 15), (5, 2000, 1)])
def test_collocations(spark, least, top, bits, monkeypatch):
    """Few counters, which most pairs share, must not change a count."""
    rows = awkward_texts()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    df = df.withColumns({n: F.lit(1) for n in ("n", "f", "phrase", "words", "w1", "rank", "counter")}).repartition(4)
    got = collocations.collocations(df, top=top, least=least, bits=bits).orderBy("lang", "rank").collect()
    assert [tuple(r) for r in got] == plain_collocations(rows, least, top)
    assert collocations.collocations(df.where("doc_id < 0"), bits=20).count() == 0


def test_windows_across_stretches(monkeypatch):
    """A long text is worked through in stretches; every window is counted once."""
    import pyarrow as pa

    monkeypatch.setattr(collocations, "_BYTES", 50)
    rng = random.Random(3)
    texts = [" ".join(rng.choice(["a", "bb", "ccc", "d,", "e\n"]) for _ in range(n)) for n in (0, 1, 30, 500, 2, 90)] + ["z" * 200, " " * 120 + "q r"]
    langs = ["en", "fr", "en", "fr", "en", "en", "en", "fr"]
    got = Counter()
    for lang, words in collocations._stretches(iter([pa.record_batch([pa.array(texts), pa.array(langs)], names=["t", "l"])])):
        for i in range(len(words) - 3):
            window = words[i : i + 4]
            if window[0] != b"\xff":
                got[lang, tuple(window[: window.index(b"\xff")] if b"\xff" in window else window)] += 1
    want = Counter()
    for text, lang in zip(texts, langs, strict=True):
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = piece.encode().split()
            for i in range(len(words)):
                want[lang, tuple(words[i : i + 4])] += 1
    assert got == want


def test_names_are_fresh(spark):
    assert fresh_folder(spark, "warc") != fresh_folder(spark, "warc") and uuid.UUID(fresh_folder(spark, "warc")[-32:])
