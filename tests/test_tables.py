import base64
import json

import pytest
from pyspark.sql import functions as F

from lexmill import plans
from lexmill.operators import aligner, documents, phrases, scoring, tables


def lines_of(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values, 1)], "line_no long, value string")


def column(df, name="value"):
    return [r[name] for r in df.collect()]


def test_positions(spark):
    df = lines_of(spark, ["b", "a", "c", "a"])
    got = tables.numbered(df, [(F.col("value"), False), (F.col("line_no"), False)], "rank", buckets=3)
    assert sorted((r["rank"], r["value"]) for r in got.collect()) == [(1, "a"), (2, "a"), (3, "b"), (4, "c")]
    down = tables.numbered(df, [(F.col("value"), True), (F.col("line_no"), False)], "rank", buckets=3)
    assert [r["value"] for r in sorted(down.collect(), key=lambda r: r["rank"])] == ["c", "b", "a", "a"]
    assert tables.numbered(df.limit(0), [(F.col("value"), False)], "rank").count() == 0


def test_cut_insert_uniq(spark):
    df = lines_of(spark, ["x", "x", "y", "x"])
    assert column(tables.uniq_adjacent(df).orderBy("line_no")) == ["x", "y", "x"]
    assert column(tables.cut_lines(df, 2, 3, [F.col("line_no")]).orderBy("line_no")) == ["x", "y"]
    with pytest.raises(ValueError):
        tables.cut_lines(df, 0, 3, [])
    assert column(tables.insert_line(df, 2, "new").orderBy("line_no")) == ["x", "new", "x", "y", "x"]
    assert column(tables.shuffle(df, 3)) == column(tables.shuffle(df.repartition(3), 3))


def test_ids_round_trip(spark):
    df = lines_of(spark, ["a b zz", "", None])
    vocab = spark.createDataFrame([(0, "_UNK"), (1, "a"), (2, "b")], "id long, word string")
    ids = tables.words_to_ids(df, vocab, ["line_no"])
    assert {r["line_no"]: r["value"] for r in ids.collect()} == {1: "1 2 0", 2: "", 3: ""}
    assert column(tables.ids_to_words(ids.where("line_no = 1"), ["_UNK", "a", "b"])) == ["a b _UNK"]
    with pytest.raises(KeyError):
        tables.words_to_ids(df, vocab.where("id > 0"), ["line_no"])


def test_scores(spark):
    h = spark.createDataFrame([(1, "the cat sat on the mat"), (2, "")], "sent_id long, value string")
    r = spark.createDataFrame([(1, "the cat sat on the mat"), (2, "x")], "sent_id long, value string")
    got = {x["sent_id"]: x for x in scoring.sentence_bleu(h, r).collect()}
    assert got[1]["bleu"] == pytest.approx(100) and got[2]["bleu"] == 0
    assert scoring.corpus_bleu(h.where("sent_id = 1"), r.where("sent_id = 1")).first()["bleu"] == pytest.approx(100)
    assert scoring.chrf(h.where("sent_id = 1"), r.where("sent_id = 1")).first()["chrf"] == pytest.approx(1)
    assert scoring.chrf(h.where("sent_id = 2"), r.where("sent_id = 2")).first()["chrf"] == 0
    lines = [x["value"] for x in scoring.bleu_report(h, r).orderBy("order").collect()]
    assert lines[0].startswith("-1=") and len(lines) == 3


def test_phrases(spark):
    rows = [("the cat", "猫", [0.5, 0.5], [0.9, 0.8], 3), ("a (b", "字", [0.5, 0.5], [0.9, 0.9], 1), ("", "字", [0.5, 0.5], [0.9, 0.9], 1), ("see the", "看", [0.5, 0.5], [0.9, 0.9], 1)]
    t = spark.createDataFrame(rows, "src string, tgt string, lexw array<double>, prob array<double>, freq long")
    got = {r["src"]: r["reason"] for r in phrases.judged(t).collect()}
    assert got == {"the cat": None, "a (b": "en_paren_mismatch", "": "empty", "see the": "en_end_with_special"}
    p = {r["src"]: r["prob"] for r in phrases.with_probabilities(t).collect()}
    assert p["a (b"] == [1.0, 0.5]


def test_word_alignment(spark):
    pairs = spark.createDataFrame([(1, "das haus", "the house"), (2, "das buch", "the book"), (3, "ein buch", "a book")], "pair_id long, src string, tgt string")
    t = aligner.word_table(pairs, 6)
    best = {r["lw"]: r["rw"] for r in t.groupBy("lw").agg(F.max_by("rw", "p").alias("rw")).collect()}
    assert best["buch"] == "book" and best["das"] == "the"
    assert {r["pair_id"]: r["links"] for r in aligner.links(pairs, t).collect()}[1] == "0-0 1-1"
    assert aligner.phrase_candidates(pairs).count() > 0


def test_documents(spark):
    df = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (1, 2, ""), (1, 3, "c")], "doc_id long, line_no int, value string")
    assert [r["value"] for r in tables.paragraphs(df).orderBy("paragraph").collect()] == ["a b", "c"]
    js = documents.document_from_lines(df).first()["json"]
    assert json.loads(js)["original_doc"]["paragraphs"] == ["a", "b", "c"]
    back = documents.extract_text(spark.createDataFrame([(js,)], "value string")).first()
    assert back["text"] == "a\nb\nc"


def test_planner(spark):
    spec = {"inputs": ["raw"], "final_outputs": ["kept", "gone"], "steps": [
        {"name": "off", "type": "file", "disable": 1, "inputs": ["raw"], "rules": [["common.Nothing", {}]], "outputs": ["none"]},
        {"name": "clean", "type": "line", "replace_empty_line": "", "inputs": ["raw"], "rules": [["common.Remove_Redundant_Spaces", {}], ["rules_en.Remove_Contain_Chinese", {}]], "outputs": ["kept", "gone"]}]}
    out = plans.Engine(spark, json.dumps(spec)).run({"raw": lines_of(spark, [" a  b", "中", "", "c"])})
    assert column(out["kept"].orderBy("line_no")) == ["a b", "c"]
    assert column(out["gone"].orderBy("line_no")) == ["2\t中", "3\t"]
    assert out["kept"].count() + out["gone"].count() == 4
    with pytest.raises(plans.SpecError):
        plans.steps_of({"steps": [{"name": "x", "type": "sql"}]})
    with pytest.raises(KeyError):
        plans.line_rules([["common.__import__", {}]])


def test_context_keeps_old_value(spark):
    spec = {"steps": [{"name": "c", "type": "context", "rules": [{"name": "rules_en.Remove_Contain_Chinese", "init_args": {}, "run_params": {"line": "$$line"}, "run_outputs": ["line"]}]}]}
    df = spark.createDataFrame([("中",), ("a",)], "line string")
    assert [r["line"] for r in plans.Engine(spark, spec).context(df).collect()] == ["中", "a"]


def test_stream(spark, tmp_path):
    from lexmill.operators.lines import get
    from lexmill.streaming import clean_stream, text_stream

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("  x  y\n\nz\n")
    q = clean_stream(text_stream(spark, str(tmp_path / "in")), get("common", "Remove_Redundant_Spaces")).writeStream.format("memory").queryName("lines_out").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r["value"] for r in spark.table("lines_out").collect()) == ["x y", "z"]


def test_entry_points_without_a_session():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def test_record_ids_are_one_piece(spark):
    url = "https://example.org/" + "a?b" * 40
    got = spark.createDataFrame([(url,)], "u string").select(documents.record_id(F.col("u"))).first()[0]
    assert got == base64.urlsafe_b64encode(url.encode()).decode()


def test_printed_probabilities_are_rounded_as_sql_rounds(spark):
    t = spark.createDataFrame([("a", "b", [0.125, 0.375], [0.565, 57 / 800], 1)], "src string, tgt string, lexw array<double>, prob array<double>, freq long")
    assert phrases.plain_lines(t, "%.2f").first()[0] == "a\tb\t0.12 0.38\t0.56 0.07\t1"
    assert phrases.moses_lines(t, "%.4f").first()[0] == "a ||| b ||| 0.1250 0.3750 0.5650 0.0712 2.718"
    assert '<prop type="probas">0.56 0.07</prop>' in phrases.tmx_lines(t, form="%.2f").first()[0]


def test_probabilities_read_their_table_once(spark):
    t = spark.createDataFrame([("a", "x", [0.5, 0.5], 3), ("a", "y", [0.5, 0.5], 1), ("b", "x", [0.5, 0.5], 1)], "src string, tgt string, lexw array<double>, freq long")
    counted = t.groupBy("src", "tgt").agg(F.sum("freq").alias("freq"), F.first("lexw").alias("lexw"))
    got = phrases.judged(phrases.with_probabilities(counted))
    assert {(r["src"], r["tgt"]): r["prob"] for r in got.collect()} == {("a", "x"): [0.75, 0.75], ("a", "y"): [0.25, 1.0], ("b", "x"): [1.0, 0.25]}
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1
