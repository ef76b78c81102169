"""Specifications of every shape of the catalogue, compiled and run on a few lines; library and nested runs; sources."""

import pytest

from lexmill import plans
from lexmill.sources import text_lines


def lines_of(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values, 1)], "line_no long, value string")


def got(df):
    return [r["value"] for r in df.orderBy("line_no").collect()]


def file_step(inputs, rules, outputs, **more):
    return {"name": "f", "type": "file", "inputs": inputs, "rules": rules, "outputs": outputs, **more}


def line_step(source, rules, outputs, token=""):
    return {"name": "l", "type": "line", "inputs": [source], "rules": rules, "outputs": outputs, "replace_empty_line": token}


def run(spark, steps, inputs, final, **options):
    return plans.Engine(spark, {"steps": steps, "inputs": list(inputs), "final_outputs": final}, **options).run({k: lines_of(spark, v) if isinstance(v, list) else v for k, v in inputs.items()})


def test_uniq_drops_neighbours_only(spark):
    out = run(spark, [file_step(["a"], [["rule_common.Uniq", {}]], ["b"])], {"a": ["b", "a", "b", "b", None, None, "a"]}, ["b"])["b"]
    assert got(out) == ["b", "a", "b", None, "a"]
    out = run(spark, [file_step(["a"], [["rule_common.Sort", {}], ["rule_common.Uniq", {}]], ["b"])], {"a": ["b", "a", "b", "b"]}, ["b"])["b"]
    assert got(out) == ["a", "b"]
    out = run(spark, [line_step("a", [["rule_en.Remove_Contain_Chinese", {}]], ["k", "_"]), file_step(["k"], [["rule_common.Uniq", {}]], ["b"])], {"a": ["x", "中", "x", "y"]}, ["b"])["b"]
    assert got(out) == ["x", "y"]  # neighbours once the line between them is gone


def test_training_set_shape(spark):
    clean = [["rule_common.Remove_Single_Quotation", {}], ["rule_common.Norm_Ellipsis", {}], ["rule_common.Remove_Redundant_Spaces", {}], ["rule_en.Remove_Contain_Chinese", {}], ["rule_common.To_Lower", {}]]
    steps = [file_step(["all"], [["rule_common.Split_To_Twin_Files", {}]], ["en", "zh"]), line_step("en", clean, ["en.c", "_"], "REMOVETHISLINE"), line_step("zh", [["rule_zh.Remove_Not_Contain_Chinese", {}]], ["zh.c", "_"], "REMOVETHISLINE"),
             file_step(["en.c", "zh.c"], [["rule_common.Combine_Twin_Files", {}], ["rule_common.Remove_Lines_With_Content", {"content": "REMOVETHISLINE"}], ["rule_common.Sort", {}], ["rule_common.Uniq", {}], ["rule_common.Split_To_Twin_Files", {}]], ["e", "z"]),
             file_step(["e"], [["rule_common.General_Tokenizer", {"lang": "en"}]], ["e.tok"])]
    out = run(spark, steps, {"all": ["The  Cat.\t猫", "A 狗\t狗", "dog\tdog", "The  Cat.\t猫", "B\t乙"]}, ["e.tok", "z"])
    assert got(out["e.tok"]) == ["b", "the cat ."] and got(out["z"]) == ["乙", "猫"]


def test_vocabulary_shape(spark):
    voc = [["rule_common.Statistic_Word_Vocab", {}], ["rule_common.Sort", {"reverse": 1, "num_sort": 1}], *[["rule_common.Insert_Line", {"line_num": 1, "content": c}] for c in ("3\t_UNK", "2\t_EOS", "1\t_GO", "0\t_PAD")], ["rule_common.Split_To_Twin_Files", {}], ["rule_common.Select_Output", {"index": [1], "output": ["top.words"]}]]
    steps = [file_step(["t"], voc, ["v"]), file_step(["v"], [["rule_common.Cut_Lines", {"start": 1, "end": 6}]], ["top"]), file_step(["v"], [["rule_common.Cut_Lines", {"start": 7, "end": 9000000}]], ["rest"]),
             file_step(["t", "top"], [["rule_common.Words_To_Tokens", {}]], ["ids"]), file_step(["ids", "top"], [["rule_common.Tokens_To_Words", {}]], ["back"]), file_step(["t"], [["rule_common.BD_Break", {"voc": "top.words", "entity_safe": "true"}]], ["broken"])]
    text = ["b a b", "c b a", "", "d <P:1>"]
    out = run(spark, steps, {"t": text}, ["top", "rest", "ids", "back", "broken"])
    assert got(out["top"]) == ["_PAD", "_GO", "_EOS", "_UNK", "b", "a"] and got(out["rest"]) == ["d", "c", "<P:1>"]
    assert got(out["ids"]) == ["4 5 4", "3 4 5", "", "3 3"] and got(out["back"]) == ["b a b", "_UNK b a", "", "_UNK _UNK"]
    assert got(run(spark, [file_step(["t"], [["rule_common.BD_Break", {"voc": "v", "entity_safe": "true"}]], ["o"])], {"t": ["ab <P:1> <N>"], "v": ["x"]}, ["o"])["o"]) == ["<B>a <E>b <P:1> <B>< <M>N <E>>"]


def test_library_shape(spark):
    spec = {"steps": [{"name": "post", "type": "sole_line", "replace_empty_line": "", "rules": [["rule_zh.Replace_Lower_Char_To_Upper_Word_Line", {"upperCharWord": ["names"]}], ["rule_zh.Find_Word_Entity", {"word_dict": "pairs"}], ["rule_zh.Remove_Space", {}]]}]}
    engine = plans.Engine(spark, spec)
    engine.tables |= {"names": lines_of(spark, ["NATO", "IBM "]), "pairs": lines_of(spark, ["IBM\t国际商业机器", "no pair"])}
    out = lines_of(spark, ["ibm 和 nato 会", "", "nato x\tNato X", "中 文"]).select("line_no", engine.line()("value").alias("value"))
    assert got(out) == ["国际商业机器和NATO会", None, "Nato x", "中文"]
    spec = {"steps": [{"name": "pre", "type": "sole_line", "rules": [["rule_common.Norm_Ellipsis", {}], ["rule_common.Segment_Jieba", {}], ["rule_common.Remove_Redundant_Spaces", {}], ["rule_common.To_Lower", {}]]}, {"name": "off", "type": "sole_line", "disable": 1, "rules": [["rule_common.Nothing", {}]]}]}
    assert got(lines_of(spark, ["A 中文", None]).select("line_no", plans.Engine(spark, spec).line()("value").alias("value"))) == ["a 中 文", None]


def test_post_chain_with_vectorised_rules(spark):
    steps = [line_step("a", [["rule_common.General_Sentence_Tokenizer", {"lang": "en"}], ["rule_en.Slot_Tag_Number_v3", {"number_tag": "<N>"}], ["rule_common.General_Sentence_Detokenizer", {"lang": "en"}], ["rule_common.BPE_Apply", {"code": "codes"}]], ["b", "_"])]
    out = run(spark, steps, {"a": ["Hello, world.", "it's (ok)"], "codes": ["#version: 0.2", "l o", "lo ,</w>"]}, ["b"])["b"]
    assert got(out) == ["H@@ e@@ l@@ lo, w@@ o@@ r@@ l@@ d@@ .", "i@@ t@@ '@@ s (@@ o@@ k@@ )"]


def test_context_shape(spark):
    rule = lambda name, init=None: {"name": name, "init_args": init or {}, "run_params": {"line": "$$line"}, "run_outputs": ["line"]}
    pre = [rule("rule_common.Pre_Replacing_Rule", {"bifrost_instance": "$$bifrost"}), rule("rule_en.Replace_Chinese_Punctuation"), rule("rule_common.Replace_HTML_Entities"), rule("rule_common.FullWidth_To_Halfwidth"), rule("rule_en.Slot_Tag_Number_v5", {"number_tag": "<N>"}),
           rule("rule_common.Remove_Redundant_Spaces"), rule("rule_common.General_Sentence_Tokenizer", {"lang": "en"}), rule("rule_common.Restore_Entity", {"entity_tag": "Person|N", "case_sensitive": "False"}), rule("rule_common.BPE_Apply_Line", {"bpe_instance": "$$bpe"})]
    services = {"Pre_Replacing_Rule": {"rules": [("1", "big apple", "New York", "", "")]}, "BPE_Apply_Line": {"codes": [("t", "h")]}}
    df = spark.createDataFrame([("big apple &amp; more", 1), ("", 2)], "line string, other int")
    out = plans.Engine(spark, {"steps": [{"name": "pre", "type": "context", "rules": pre}]}, services=services).context(df).orderBy("other").collect()
    assert out[0]["line"].replace("@@ ", "") == "New York &amp; more" and out[1]["line"] == ""


def test_scoring_and_alignment_shapes(spark):
    seg = [["rule_zh.Segment_Jieba_Then_Char", {}]]
    steps = [line_step("c", seg, ["c2", "_"]), line_step("r", seg, ["r2", "_"]), file_step(["c2", "r2"], [["rule_common.Bleu", {}], ["rule_common.Sort", {"num_sort": 1}]], ["bleu"])]
    out = got(run(spark, steps, {"c": ["我 们 好 的", "你们"], "r": ["我 们 好 的", "他们"]}, ["bleu"])["bleu"])
    assert len(out) == 3 and out[0].startswith("-1====") and out[1].startswith("0.00\tline_num:2") and out[2].startswith("100.00\tline_num:1")
    steps = [file_step(["en", "zh"], [["rule_common.Combine_Twin_Files", {"delim": " ||| "}], ["rule_common.Select_Output", {"index": [0], "output": ["formatted"]}], ["rule_common.Fast_Align", {}]], ["prob", "links"]), file_step(["prob"], [["rule_common.WordProb_To_PKL", {}]], ["lists"])]
    out = run(spark, steps, {"en": ["the house", "the book"], "zh": ["das haus", "das buch"]}, ["links", "lists", "formatted"])
    assert got(out["links"])[0] == "0-0 1-1" and got(out["formatted"])[0] == "the house ||| das haus" and len(got(out["lists"])) == 3


def test_documents_and_translation_shapes(spark):
    steps = [file_step(["d"], [["rule_common.Extract_Text_From_Raw_Doc", {}]], ["text", "meta"]), line_step("text", [["rule_common.Norm_Ellipsis", {}], ["rule_en.Remove_Bullet", {}]], ["t2", "_"]), file_step(["t2"], [["rule_en.Segment_EN_Doc_To_Sentences", {}]], ["s"]),
             file_step(["s"], [["rule_common.Translate_3rd_Party", {"engine": "bing", "from": "en", "to": "zh"}]], ["zh"]), file_step(["s", "zh"], [["rule_common.Group_Lines_With_Tags_If_Exist", {"tags": ["[S]", "[T]"]}]], ["both"])]
    doc = '{"original_doc": {"source": "http://x", "paragraphs": ["One. Two is here.", "Three."]}}'
    out = run(spark, steps, {"d": [doc]}, ["s", "both"], services={"translate": lambda texts: [t.upper() for t in texts]})
    assert got(out["s"]) == ["One.", "Two is here.", "", "Three.", ""] and got(out["both"])[0] == "[S]One.\n[T]ONE.\n"
    made = []
    steps = [file_step(["m"], [["rule_common.Create_ES_Index_If_No_Exists", {"host": "h", "index": "i", "type": "t"}]], ["_"])]
    run(spark, steps, {"m": ["{}"]}, [], services={"create_index": lambda *a: made.append(a)})
    assert made == [("h", "i", "t", "{}")]
    with pytest.raises(plans.SpecError):
        run(spark, steps, {"m": ["{}"]}, [])


def test_bad_specifications(spark):
    for rules, kind in (([["rule_common.Uniq", {"colour": 1}]], "file"), ([["rule_common.To_Lower", {"colour": 1}]], "line"), ([["rule_common.Replace_Content", {}]], "file"), ([["rule_common.Select_Output", {"index": [3]}]], "file"), ([["rule_common.Cut_Lines", {"start": 0, "end": 2}]], "file")):
        step = file_step(["a"], rules, ["b"]) if kind == "file" else line_step("a", rules, ["b", "_"])
        with pytest.raises(plans.SpecError):
            run(spark, [step], {"a": ["x"]}, ["b"])
    with pytest.raises(plans.SpecError):
        plans.Engine(spark, {"steps": [file_step(["a"], [], ["b"])], "final_outputs": ["c"]})


def test_nested_runs_over_a_list_of_files(spark, tmp_path):
    for n, text in (("one.txt", "A\n\nb\n"), ("two.txt", "C\n")):
        (tmp_path / n).write_text(text)
    sub = {"inputs": ["raw"], "final_outputs": ["low"], "startover": 0, "steps": [line_step("raw", [["rule_common.To_Lower", {}]], ["low", "_"])]}
    steps = [file_step(["list"], [["rule_super.Run_Schema", {"schema": sub, "generator": "Generator_Loop_File_List"}]], ["done", "failed"])]
    names = [f"{tmp_path}/{n}" for n in ("one.txt", "missing.txt", "two.txt")]
    out = run(spark, steps, {"list": names}, ["done", "failed"], workdir=f"{tmp_path}/work")
    assert got(out["done"]) == [f"{tmp_path}/{n}\t{tmp_path}/work/{n}" for n in ("one.txt", "two.txt")] and got(out["failed"]) == []
    assert sorted(r["value"] for r in spark.read.text(f"{tmp_path}/work/one.txt/low").collect()) == ["a", "b"]
    (tmp_path / "one.txt").write_text("Z\n")
    run(spark, steps, {"list": names}, ["done"], workdir=f"{tmp_path}/work")  # results are there: startover 0 keeps them
    assert sorted(r["value"] for r in spark.read.text(f"{tmp_path}/work/one.txt/low").collect()) == ["a", "b"]


def test_lines_of_large_files_keep_their_numbers(spark, tmp_path):
    for n in (3000, 10, 5000):
        (tmp_path / f"{n}.txt").write_text("".join(f"{n} {i} {'x' * (i % 50)}\n" for i in range(1, n + 1)))
    (tmp_path / "empty.txt").write_text("")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        df = text_lines(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 8
        rows = df.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 8010 and all(r["value"].split()[1] == str(r["line_no"]) and r["file"].endswith(f"/{r['value'].split()[0]}.txt") for r in rows)
