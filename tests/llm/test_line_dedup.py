from entiscore.llm.line_dedup import dedup_lines

INF = float("inf")


def brute(rows):
    """kept text by (doc_id, text), straight from the definition."""
    found = {}
    distinct = sorted(set(rows), key=lambda r: (INF if r[0] is None else r[0], r[1] or ""))
    for i, t in distinct:
        ls = [] if t is None else t.split("\n")
        for p in range(len(ls) - 2):
            w = tuple(ls[p:p + 3])
            if "".join(w).strip(" \t\n\x0b\x0c\r"):
                found.setdefault(w, []).append((INF if i is None else i, t, p))
    gone = {}
    for at in found.values():
        least = min(a[0] for a in at)
        for i, t, p in at:
            if i > least or any(o[0] == i and o[1] == t and o[2] < p for o in at):
                gone.setdefault((i, t), set()).update((p, p + 1, p + 2))
    out = {}
    for i, t in distinct:
        ls = [] if t is None else t.split("\n")
        g = gone.get((INF if i is None else i, t), set())
        out[i, t] = (None if t is None else "\n".join(x for k, x in enumerate(ls) if k not in g), len(ls), len(g))
    return out


def check(spark, make_docs, rows, **more):
    got = sorted(((r["doc_id"], r["text"], r["n_lines"], r["n_removed"])
                  for r in dedup_lines(make_docs(rows, **more)).collect()), key=repr)
    want = brute(rows)
    assert got == sorted(((i, *want[i, t]) for i, t in rows), key=repr)
    return got


def test_against_brute_force_with_edges(spark, make_docs):
    lines = [f"line {k}" for k in range(8)]
    rows = [(5, "\n".join(lines)), (2, "\n".join(["x", *lines[2:6], "y"])), (9, "\n".join(lines[:4] + lines[:4])),
            (1, None), (3, ""), (4, "one"), (6, "a\nb"), (7, "\n\n\n\n"), (8, "\n\n\n\n"), (10, "q\n\n\nr"),
            (11, "q\n\n\nr"), (None, "\n".join(lines)), (12, "\n".join(lines)), (12, "\n".join(lines)),
            (12, "\n".join(lines[1:])), (13, "same\n" * 9), (14, "same\n" * 9)]
    got = check(spark, make_docs, rows)
    assert (12, "", 8, 8) in got and (8, "\n\n\n\n", 5, 0) in got


def test_random_texts(spark, make_docs):
    import random
    r = random.Random(3)
    rows = [(i, "\n".join(r.choice("abcd") for _ in range(r.randrange(0, 14)))) for i in range(120)]
    check(spark, make_docs, rows)


def test_clashing_columns_long_text_and_empty_table(spark, make_docs):
    long = "\n".join(f"row {k}" for k in range(20_000))
    rows = [(1, long), (2, "head\n" + long), (3, "clean\ntext\nhere")]
    out = dedup_lines(make_docs(rows, n_lines="mine", _id="x", _row="y", pos=1))
    got = {r["doc_id"]: r for r in out.collect()}
    assert got[2]["text"] == "head" and got[2]["n_removed"] == 20_000 and got[3]["n_removed"] == 0
    assert got[1]["_id"] == "x" and got[1]["_row"] == "y" and got[1]["n_lines"] == 20_000
    assert dedup_lines(make_docs([])).count() == 0


def test_frequent_window_across_many_documents(spark, make_docs):
    rows = [(i, f"own {i}\ncommon a\ncommon b\ncommon c\nend {i}") for i in range(400)]
    got = check(spark, make_docs, rows)
    assert sum(r[3] for r in got) == 399 * 3
