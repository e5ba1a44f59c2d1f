import re
from collections import Counter

from entiscore.llm import quality_rules as Q

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    ws = SPACE.findall(text)
    wins = Counter(tuple(ws[i:i + 3]) for i in range(len(ws) - 2))
    hit = {i + k for i in range(len(ws) - 2) if wins[tuple(ws[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if SPACE.search(x)]
    return (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit))


TEXTS = [None, "", "   \n\t", "one", "a b c", "a b c a b c", "x x x x x x", "a b a b a b a", "l1 w\nl1 w\n\nl2\nl1 w",
         " wide space stays", "émigré naïve 漢字 😀 &*#", "a  b\tc\x0bd\x0ce\rf", "!!! ### $$$ |", "\n\n\n",
         " ".join(f"w{k}" for k in range(80)), " ".join(["spam ham eggs"] * 40),
         " ".join(f"w{k % 50}" for k in range(20_000))]


def test_measurements_match_brute_force(spark, make_docs):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "null id"), (3, "one")]
    out = Q.ledger(make_docs(rows)).collect()
    got = sorted(((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
                  for r in out), key=repr)
    assert got == sorted(((i, *brute(t)) for i, t in rows), key=repr)


def test_policies_and_ablations_read_the_ledger_only(spark, make_docs):
    clean = " ".join(f"word{k}" for k in range(60))
    rows = [(1, clean), (2, "few words"), (3, " ".join(["a b c"] * 30)), (4, clean.replace("word", "word###")),
            (5, clean.upper()), (6, None)]
    entries = Q.ledger(make_docs(rows))
    kept = {r["doc_id"]: r["kept"] for r in Q.apply_policy(entries).collect()}
    assert kept == {1: True, 2: False, 3: False, 4: False, 5: False, 6: False}
    base = {r["doc_id"]: r["kept"] for r in Q.apply_policy(entries, Q.BASE).collect()}
    assert base == {1: True, 2: False, 3: False, 4: True, 5: True, 6: False}
    table = {r["rule"]: r for r in Q.ablations(entries, Q.BASE).collect()}
    assert table["few_words"]["n_failed"] == 2 and table["few_words"]["n_only"] == 2
    assert table["repeated_words"]["n_only"] == 1 and table["repeated_words"]["failed_with"] == 2
    assert all(r["n_docs"] == 6 for r in table.values())


def test_clashing_columns_and_empty_table(spark, make_docs):
    out = Q.apply_policy(Q.ledger(make_docs([(1, "a b c")], n_words="mine", _words="x", failed=7))).collect()[0]
    assert out["n_words"] == 3 and out["_words"] == "x" and out["failed"] == 33
    assert Q.ledger(make_docs([])).count() == 0
    assert Q.ablations(Q.ledger(make_docs([]))).count() == 0


def test_no_python_in_the_plan(spark, make_docs):
    plan = Q.apply_policy(Q.ledger(make_docs([(1, "a")])))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Join" not in plan
