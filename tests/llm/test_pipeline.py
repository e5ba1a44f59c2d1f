"""The pipeline against a brute-force version of each stage, and the registered queries."""

import hashlib
import re

import pytest

import __spark_entry__
import corpus_pipeline as C
from entiscore.llm import jaccard, langid, packing, queries
from tests.llm.test_classifiers import ALPHABETS
from tests.llm.test_jaccard import brute as classes
from tests.llm.test_line_dedup import brute as deduped
from tests.llm.test_mixing import fill
from tests.llm.test_packing import reference_ids


@pytest.fixture(scope="module")
def corpus(spark, make_docs, prose, tmp_path_factory):
    lines = lambda i, k, n: "\n".join(" ".join(prose(100 * i + j, 7, ALPHABETS[k])) for j in range(n))
    rows = [(i, lines(i, k, 1 + i % 5), k, f"s{i % 4}") for i, k in enumerate(k for _ in range(25) for k in ALPHABETS)]
    rows += [(200, rows[3][1], "xx", "s0"), (201, rows[4][1] + "\nsome more words", None, "s1"),
             (202, "own start\n" + rows[4][1] + "\nown end", "yy", None), (203, "123 !!", "xx", "s1"), (204, None, None, "s2"),
             (205, "", "xx", "s0"), (206, " ".join(prose(5, 60, ALPHABETS["xx"])), "xx", "s3"),
             (207, " ".join([*prose(5, 60, ALPHABETS["xx"]), "end"]), "xx", "s3"), (207, "ba ke", "xx", "s3"),
             (208, "ba lo", None, "s3"), (208, "ba lo", None, "s3"), (None, "tsch ung", "yy", "s2")]
    docs = make_docs(rows)
    folder = str(tmp_path_factory.mktemp("sf"))
    docs.write.parquet(f"{folder}/documents.parquet")
    return folder, rows


def rows_of(df):
    return sorted(((r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in df.collect()), key=repr)


def test_stages_match_brute_force(spark, corpus):
    folder, rows = corpus
    docs = C.read(spark, folder, "documents")
    columns = docs.columns
    assert [n for n, _ in C.STAGES] == ["language_id", "line_dedup", "jaccard_join", "mixing", "best_fit_packing"]

    named = spark.createDataFrame(C.language_id(spark, docs, folder).collect(), docs.schema)
    want = [r for r in rows if r[1] and re.search(r"[^\W\d_]", r[1])]
    assert named.columns == columns
    assert rows_of(named) == sorted(((*r, len(r[1])) for r in want), key=repr)

    kept = deduped([r[:2] for r in want])
    want = [(i, kept[i, t][0], lang, src, len(kept[i, t][0])) for i, t, lang, src in want]
    lined = spark.createDataFrame(C.dedup_lines(spark, named, folder).collect(), docs.schema)
    assert lined.columns == columns and rows_of(lined) == sorted(want, key=repr)

    s = jaccard.Settings(shingle=5, num=80, den=100)
    single = sorted(set(want), key=lambda r: (r[0] is None, r[0] or 0))
    parts = {}
    for r in single:                                       # one text each, so classes() can name it by place
        parts[len(parts)] = r
    heads = {c for _, n, c in classes([(k, r[1]) for k, r in parts.items()], s) if n}
    want = [r for k, r in parts.items() if k in heads or not jaccard.shingle_set(r[1], 5).size]
    ones = spark.createDataFrame(C.one_of_each(spark, lined, folder).collect(), docs.schema)
    assert ones.columns == columns and rows_of(ones) == sorted(want, key=repr)

    sizes, groups = {}, {}
    for r in want:
        n = len(r[1].split())
        sizes[r[3]] = sizes.get(r[3], 0) + n
        cell = int(hashlib.md5(("" if r[0] is None else str(r[0])).encode()).hexdigest()[:2], 16)
        groups.setdefault(r[3], []).append((n, cell, -1 if r[0] is None else r[0], r))
    target, expected = fill(sizes), []
    for src, members in groups.items():
        u = int(hashlib.md5(("mix:" + (src or "")).encode()).hexdigest()[:4], 16) / 65536
        e = target[src] / sizes[src] if sizes[src] else 0
        for k, (*_, r) in enumerate(sorted(members, key=lambda m: m[:3])):
            expected += [r] * (int(e * (k + 1) + u + 1e-12) - int(e * k + u + 1e-12))
    mixed = spark.createDataFrame(C.mix(spark, ones, folder).collect(), docs.schema)
    assert mixed.columns == columns and rows_of(mixed) == sorted(expected, key=repr)

    pieces = C.pack(spark, mixed, folder).collect()
    lengths = sorted(n for r in expected for _, n in packing.cut(len(reference_ids(r[1])), 1024))
    assert sorted(p["length"] for p in pieces) == lengths
    ends = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == ends.get(p["sequence_id"], 0)
        ends[p["sequence_id"]] = p["offset"] + p["length"]
    assert max(ends.values()) <= 1024


def test_run_equals_its_stages_and_is_registered(spark, corpus):
    folder, _ = corpus
    out = C.run(spark, folder)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 60
    names = __spark_entry__.queries()
    assert names["pipeline"] is C.run
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names if n.startswith("op")) == list(range(1, 14))


def test_language_stage_without_any_language_keeps_texts_with_letters(spark, make_docs):
    rows = [(1, "ba ke lo", None, "s"), (2, "12 !", None, "s"), (3, None, None, "s"), (None, "é", None, None), (4, "", None, "s"), (1, "ba ke lo", None, "s")]
    out = C.language_id(spark, make_docs(rows, lang_pred="mine", score=2), "")
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr) == sorted([(1, "ba ke lo"), (1, "ba ke lo"), (None, "é")], key=repr)
    assert {(r["lang_pred"], r["score"]) for r in out.collect()} == {("mine", 2)}


def test_language_stage_follows_the_verdict_of_the_model(spark, make_docs, prose):
    rows = [(i, " ".join(prose(i, 60, ALPHABETS[k])), k, "s") for i, k in enumerate(k for _ in range(20) for k in ALPHABETS)]
    docs = make_docs(rows + [(900, "漢字仮名交文書体系 " * 30, None, "s"), (901, "12 34", None, "s"), (902, "a", None, "s")])
    model = langid.train(docs)
    told = langid.identify(docs, model).collect()
    out = {r["doc_id"] for r in C.language_id(spark, docs, "").collect()}
    assert out == {r["doc_id"] for r in told if r["lang_pred"] != "und" and r["score"] >= C.LEAST_ODDS / len(model.languages)}
    assert {r[0] for r in rows} <= out and not {900, 901} & out


def test_empty_documents_pass_through(spark, make_docs, tmp_path):
    make_docs([]).write.parquet(str(tmp_path / "documents.parquet"))
    assert C.run(spark, str(tmp_path)).count() == 0
    for name, q in queries.queries().items():
        if not re.match(r"op(1|6|9|12)_", name):           # those read other tables too
            assert q(spark, str(tmp_path)).count() == 0, name


def test_result_columns(spark, corpus):
    folder, rows = corpus
    spark.createDataFrame([(i, int(i % 3 > 0), int(i % 4 == 0)) for i in range(75)],
                          "doc_id long, quality int, toxic int").write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    want = {
        "op3_substring_dedup": {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
        "op4_quality_rules": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint",
                              "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
        "op5_best_fit_packing": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint",
                                 "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
        "op6_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
        "op7_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
        "op8_mixing": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
        "op9_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
        "op10_jaccard_join": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
        "op11_spelling_variants": {"word": "string", "n": "bigint", "n_near": "bigint", "form": "string", "form_n": "bigint",
                                   "root": "string"},
        "op13_source_divergence": {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint",
                                   "rank": "int"},
    }
    for name, columns in want.items():
        out = queries.queries()[name](spark, folder)
        assert columns.items() <= dict(out.dtypes).items(), name
        if not re.match("op(5|11|13)_", name):
            assert out.count() == len(rows), name
