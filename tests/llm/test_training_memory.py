"""Training runs on the driver: its memory must stay far below the driver's."""

import random
import tracemalloc

from tallyworks.llm import toxicity


def test_training_holds_little_at_once():
    deal = random.Random(5)
    words = ["".join(deal.choices("abcdefghijklmnopqrstuvwxyz", k=deal.randint(4, 46))) for _ in range(2000)]
    rows = [(" ".join([*deal.choices(words, k=20), f"bad{i % 7}"[: 4 * (i % 2)]]), i % 2) for i in range(300)]
    tracemalloc.start()
    try:
        model = toxicity.train(rows, keep=1000)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert model is not None and peak < 110 << 20
