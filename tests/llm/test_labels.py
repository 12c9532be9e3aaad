"""Labels are joined to classes before the classes are spread over their groups."""

import random

from tallyworks.llm import jaccard


def test_labels_meet_classes_not_places_in_groups(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    draw, plans, dealt = random.Random(5), [], jaccard._blocks

    def blocks(members):
        plans.append(members._jdf.queryExecution().optimizedPlan().toString())
        return dealt(members)

    monkeypatch.setattr(jaccard, "_blocks", blocks)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(24):
        words = passage + [f"w{i // 2}x{j}" for j in range(60)]
        if i % 2:
            words[draw.randrange(60, 120)] = f"own{i}"
        rows.append((i, " ".join(words)))
    found = {r.doc_id: r.component_id for r in jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {i: i - i % 2 for i in range(24)}
    assert plans and all(p.index("Join Inner") < p.index("Join LeftOuter") for p in plans)
