"""Filter audit against a brute force that walks every document through every order."""

from itertools import permutations

import re

from tickflow.llm import filter_audit

LONG = " ".join(f"w{i}" for i in range(30000))
TEXT = " ".join(f"w{i}" for i in range(60))
DOCS = [(1, TEXT, "s"), (2, TEXT, "t"), (2, TEXT, "t"), (5, TEXT, "s"), (None, TEXT, "s"), (3, None, None), (4, "", ""), (None, None, "s"), (6, "A B", "s"),
        (7, "a " * 80, "t"), (8, TEXT + " $", "t"), (9, LONG, "t"), (10, LONG, "s"), (11, "É" * 60, "s"), (12, "x\x0by\x1cz " * 30 + "|", None), (13, "TOP " * 9, "u"), (13, "TOP " * 9, "u")]
LABELS = [(1, 1, 0), (2, None, 1), (2, 1, 0), (5, 1, 1), (8, 0, 1), (9, 1, None), (None, 1, 1), (99, 1, 1), (4, 1, 0)]


def brute_force(docs, labels):
    out = {}
    for part in {p or "" for _, _, p in docs}:
        rows = []
        for doc_id, text, p in docs:
            t = text or ""
            words = re.findall(r"[^\x20\x09-\x0D]+", t)
            same = [i for i, other, _ in docs if (other or "") == t and i is not None]
            fails = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                     "D": bool(re.search(r"[#$%&*|]", t)), "E": bool(same) and (doc_id is None or doc_id > min(same))}
            own = [x for x in labels if doc_id is not None and x[0] == doc_id]
            if (p or "") == part:
                rows.append((fails, any(x[1] == 1 for x in own), any(x[2] == 1 for x in own)))
        worth = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                alive = [not any(r[0][g] for g in order[:step - 1]) for r in rows]
                gone = [r for r, a in zip(rows, alive) if a and r[0][f]]
                worth[f] += len(gone)
                out[part, "".join(order), step] = [
                    sum(a and not r[0][f] for r, a in zip(rows, alive)), len(gone), sum(not a and r[0][f] for r, a in zip(rows, alive)),
                    sum(r[0][f] and sum(r[0].values()) == 1 for r in rows), sum(r[1] for r in gone), sum(r[2] for r in gone)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(worth[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def table(df):
    return {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in df.collect()}


def test_audit_equals_brute_force(spark):
    docs = spark.createDataFrame([(*r, 7, "m", True) for r in DOCS], "doc_id bigint, text string, source string, n int, mask string, good boolean")
    labels = spark.createDataFrame([(*r, "d") for r in LABELS], "doc_id bigint, quality int, toxic int, digest string")
    got = filter_audit.audit(filter_audit.mask_cells(docs, labels))
    assert got.count() == 600 * 4 and table(got) == brute_force(DOCS, LABELS)
    assert table(filter_audit.audit(filter_audit.mask_cells(docs.repartition(5), labels))) == brute_force(DOCS, LABELS)
    assert filter_audit.audit(filter_audit.mask_cells(docs.limit(0), labels)).count() == 0
    none = filter_audit.audit(filter_audit.mask_cells(docs, labels.limit(0)))
    assert table(none) == brute_force(DOCS, [])


def test_cells_hold_every_row(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    cells = filter_audit.mask_cells(docs, spark.read.parquet("/root/testdata/sf0.001/labels.parquet")).collect()
    assert sum(c.n for c in cells) == docs.count() and len({(c.part, c["mask"]) for c in cells}) == len(cells)
