"""Tables of chunks and transducers give the same results however small their bounds."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tallyworks.llm import bytebpe, text, toxicity


@pytest.mark.parametrize(("most", "most_bytes"), [(10**9, 1 << 40), (50, 1 << 40), (10**9, 5000), (1, 1)])
def test_chunk_table(most, most_bytes):
    rng = random.Random(1)
    worked = []

    def work(chunks):
        worked.extend(chunks)
        return [np.arange(len(c)) + ord(c[0]) for c in chunks]

    table = text.ChunkTable(work, most=most, most_bytes=most_bytes)
    for _ in range(60):
        chunks = ["often" if rng.random() < 0.3 else rng.choice("abc") * rng.choice([1, 2, 3, rng.randrange(1, 3000)]) for _ in range(rng.randrange(0, 40))]
        codes = table.codes(chunks)
        assert table.sizes(codes).tolist() == [len(c) for c in chunks]
        assert table.gather(codes).tolist() == [v for c in chunks for v in range(ord(c[0]), ord(c[0]) + len(c))]
        assert len(table.codes_of) <= most + 40 and table.kept <= most and table.held <= most_bytes
    assert most > 1 or len(worked) > 60
    assert most != 50 or worked.count("often") == 1  # what is met first stays


def test_many_distinct_long_chunks_stay_within_bytes():
    table = text.ChunkTable(lambda chunks: [np.zeros(1, np.int64)] * len(chunks), most_bytes=8 << 20)
    for group in range(100):
        table.codes([f"{group}-{i}-" + "x" * 2000 for i in range(1000)])  # 100,000 of them
        assert table.held <= 8 << 20 and table.kept < 4200 and len(table.codes_of) <= table.kept + 1000


def test_a_worker_keeps_one_kind_of_state():
    text._STATE.clear()
    one = text.worker_state("a", "table 1", list)
    assert text.worker_state("a", "table 1", list) is one
    other = text.worker_state("a", "digits 1", list)
    assert text.worker_state("a", "table 1", list) is one and text.worker_state("a", "digits 1", list) is other
    assert text.worker_state("a", "table 2", list) is not one and set(text._STATE) == {("a", "table 2"), ("a", "digits 1")}
    text.worker_state("b", "table 1", list)
    assert set(text._STATE) == {("b", "table 1")}
    text._STATE.clear()


@pytest.mark.parametrize(("states", "meetings"), [(2, 1), (50, 1), (50, 4), (30_000, 2)])
def test_transducer_within_any_bound(monkeypatch, states, meetings):
    monkeypatch.setattr(bytebpe, "MOST_STATES", states)
    monkeypatch.setattr(bytebpe, "MEETINGS", meetings)
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = bytebpe.read_ranks(path)
    plain = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(2)
    words = ["".join(rng.choice("aeinrstlou éüß中") for _ in range(rng.randrange(1, 14))) for _ in range(400)]
    texts = [" ".join(rng.choice(words) for _ in range(60)) for _ in range(12)] + ["x" * 3000 + "yz" * 700]
    encoder = bytebpe.Encoder(ranks, public_tokenizers.PATTERN)
    for t, (_, ids) in zip(texts, encoder.encode_batch(texts), strict=True):
        assert ids.tolist() == plain.encode_ordinary(t)
    assert len(encoder.transducer.held) <= states + 1


def test_margins_do_not_depend_on_the_parts(monkeypatch):
    rng = np.random.default_rng(3)
    model = toxicity.Model(rng.normal(size=toxicity.SYMBOLS**3).astype(np.float32), -0.2, np.zeros(4))
    model.weight[0] = 0
    units = ["".join(rng.choice(list("abcdeidot"), size=n)) for n in rng.integers(1, 38, 300)]
    whole = model.margins(units)
    monkeypatch.setattr(toxicity, "CELLS", 90)
    assert np.allclose(model.margins(units), whole, atol=1e-4) and len(model.margins([])) == 0
