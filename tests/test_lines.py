"""Golden strings for line operators, written from the described behaviour."""

import pytest
from pyspark.sql import functions as F

from lexmill.operators import alignment, lines, replacer, segmenter, slots, subword, tokenizer  # noqa: F401

GOLDEN = [
    ("common", "Remove_Redundant_Spaces", {}, "  a   b ", "a b"),
    ("common", "Remove_Square_Content", {}, "a (b) 【c】 d", "a   d"),
    ("common", "Remove_Single_Quotation_v2", {}, "d'Or 'x' cats' it's", "d'Or x cats' it's"),
    ("common", "Remove_Single_Quotation_v2", {}, "a''b s''", "a'b s'"),
    ("common", "Remove_Bad_Begin", {}, ",. -> hello", "hello"),
    ("common", "Remove_Heading_Numbers", {}, "12. 3, hello", "hello"),
    ("common", "Remove_Heading_Numbers", {}, "2019 was", "2019 was"),
    ("common", "Entity_URL", {}, "see http://a.b/c now", "see <URL> now"),
    ("common", "FullWidth_To_Halfwidth", {}, "ＡＢＣ１２３", "ABC123"),
    ("common", "BPE_Recover", {}, "lo@@ wer", "lower"),
    ("common", "BD_Recover", {}, "<B>w <M>o <M>r <E>d", "word"),
    ("common", "Pair_Punctuation_Close_Check", {}, 'a(b)[c]"x"', 'a(b)[c]"x"'),
    ("common", "Pair_Punctuation_Close_Check", {}, "(]", None),
    ("common", "Replace_HTML_Entities", {}, "Fish &amp; chips &#39;x&#39; ", "Fish & chips 'x'"),
    ("common", "Levenshtein_Distance", {"mode": "word"}, "a b c\ta c", "1"),
    ("common", "Levenshtein_Distance", {}, "kitten\tsitting", "3"),
    ("common", "Fix_Labels", {}, "See (Fig.\t参见（图1）。", "See \t参见"),
    ("common", "Fix_Labels", {}, "See\t（图（图", None),
    ("common", "Restore_Entity", {"entity_tag": "N"}, "x <N>33303030</N> y", "x <N:MzAwMA==> y"),
    ("common", "Pair_Slot_Tag_Number", {}, "worth 3 million now\t价值300万元", "worth <N> now\t价值<N>元"),
    ("common", "Pair_Slot_Tag_NoTrans", {}, "mail a.b@c.org today\t写信 a.b@c.org 吧", "mail <NOTRANS> today\t写信 <NOTRANS> 吧"),
    ("en", "Remove_Bullet_v2", {}, "(iv) second", " second"),
    ("en", "Dedupe_Repeated_Punctuation", {}, "wow!!! ok..", "wow! ok."),
    ("en", "Separate_Currency_Number", {}, "USD100 and $5", "USD 100 and $ 5"),
    ("en", "Capitalize", {}, "hello World", "Hello World"),
    ("en", "Split_Compound_Word", {"connector_tag": "<->"}, "well-known fact", "well <-> known fact"),
    ("en", "Remove_Contain_Chinese", {}, "a 中", None),
    ("en", "Slot_Tag_Number", {}, "paid 1,000 in 5", "paid  N  in  N"),
    ("en", "Slot_Tag_Number_v2", {}, "paid 1,000 in 5", "paid  N  in  5"),
    ("en", "Slot_Tag_Number_v3", {"number_tag": "<N>"}, "x 3000 y", "x  <N>33303030</N>  y"),
    ("en", "Catch_Contain_Upper_Character_Word", {}, "The European Union and NATO met", "\n European Union\n NATO\n".lstrip("\n")),
    ("zh", "Slot_Tag_Number", {}, "5月 300 人", "5月   N  人"),
    ("zh", "Remove_Space", {}, "ab c d 中 文", "ab cd中文"),
    ("zh", "Separate_Chinese_Char", {}, "ab中文", "ab 中 文"),
    ("zh", "Recover_Separated_Chinese_Char", {}, "ab cd 中 文 x", "ab cd中文x"),
    ("zh", "Remove_Pic_Note", {}, "a图b", None),
    ("zh", "Remove_Pic_Note", {}, "试图成功", "试图成功"),
    ("zh", "Remove_Chinese_Number_Unit_After_Number_Entity", {}, "N 万亿元", "N元"),
    ("zh", "Segment_Jieba_Then_Char", {"dictionary": {"中文": 9}}, "中文abc", "中 文 abc"),
    ("zh", "Seg_Chinese_Only_In_Sentence", {"dictionary": {"中文": 9}}, "中文字abc-d", "中文 字 abc-d"),
    ("common", "General_Tokenizer", {}, "It's 5,300 or A,B... Mr. X left.", "It &apos;s 5,300 or A , B ... Mr. X left ."),
    ("common", "General_Sentence_Tokenizer", {}, "see http://host/c?d=1 now.", "see http://host/c?d=1 now ."),
    ("common", "General_Sentence_Detokenizer", {}, 'It &apos;s &quot; fine &quot; , ( yes ) !', 'It\'s "fine", (yes)!'),
    ("common", "BPE_Apply_Line", {"codes": [("t", "h"), ("th", "e</w>")]}, "the <N:x> t", "the <N:x> t"),
    ("common", "Post_Replacing_Rule", {"rules": [("1", "", "", "of the", "X"), ("2", "", "", "of", "Y")]}, "of the of offer", "X Y offer"),
]


@pytest.mark.parametrize(("language", "name", "params", "line", "expected"), GOLDEN, ids=[f"{g[0]}-{g[1]}-{i}" for i, g in enumerate(GOLDEN)])
def test_golden(spark, language, name, params, line, expected):
    got = spark.createDataFrame([(line,)], "v string").select(lines.get(language, name, **params)(F.col("v"))).first()[0]
    assert got == expected


def test_null_and_empty_are_dropped(spark):
    df = spark.createDataFrame([(None,), ("",)], "v string")
    needed = {"Replace_Content": {"pattern": "a", "repl": "b"}, "BD_Break_Line": {"voc": ["a"]}, "Replace_Words_Per_Dict": {"words": ["A"]}, "Find_Word_Entity": {"table": {"ab": "c"}}, "BPE_Apply_Line": {"codes": []}, "BPE_Apply": {"codes": []}}
    keys = sorted(lines.REGISTRY)
    assert len(keys) > 90
    for i in range(0, len(keys), 20):
        part = keys[i : i + 20]
        rows = df.select(*(lines.get(*key, **needed.get(key[1], {}))(F.col("v")).alias("_".join(key)) for key in part)).collect()
        assert [[k for k, x in r.asDict().items() if x is not None] for r in rows] == [[], []]


def test_vectorised_rules_stand_above_all_others(spark):
    """Spark must find a vectorised function above every line rule: each is followed by the detokenizer here."""
    df = spark.createDataFrame([("see 1,234 people's &lt; N &gt; 中文 a-b http://x/y (ok).",)], "v string")
    needed = {"Replace_Content": {"pattern": "a", "repl": "b"}, "BD_Break_Line": {"voc": ["a"]}, "Replace_Words_Per_Dict": {"words": ["A"]}, "Find_Word_Entity": {"table": {"ab": "c"}}, "BPE_Apply_Line": {"codes": []}, "BPE_Apply": {"codes": []}, "Restore_Entity": {"entity_tag": "N"}}
    last = lines.get("common", "General_Sentence_Detokenizer")
    failed = []
    for key in sorted(lines.REGISTRY):
        try:
            df.select(lines.chain([lines.get(*key, **needed.get(key[1], {})), last])(F.col("v"))).collect()
        except Exception as e:
            failed.append((key, str(e)[:80]))
    assert not failed


def test_idempotent(spark):
    df = spark.createDataFrame([("  a,,b  --  c ",), ("x..!!",)], "v string")
    for key in [("common", "Remove_Redundant_Spaces"), ("en", "Dedupe_Repeated_Punctuation")]:
        op = lines.get(*key)
        assert df.select(op(F.col("v"))).collect() == df.select(op(op(F.col("v")))).collect()


def test_long_chains_stay_linear(spark):
    op = lines.chain([lines.get("common", "Norm_Ellipsis"), lines.get("en", "Capitalize"), lines.get("en", "Remove_Contain_Chinese"), lines.get("common", "To_Lower")] * 5)
    assert spark.createDataFrame([("abc",)], "v string").select(op(F.col("v"))).first()[0] == "abc"


def test_align_and_case():
    assert alignment.align(["ne@@", "w", "york", "<->", "x"], ["Ne@@", "w", "York", "'s", "city"], [0, 1, 2, 3, 5], True) == (["new", "york-", "x"], ["New", "York's", "city"], [0, 1, 3])
    assert alignment.align([], ["a"], [0], True) is None
    assert alignment.restore_case("the ips of nato", "IPs of NATO in The", True) == "The IPs of NATO"
    assert alignment.restore_case("the ip of x", "IPs of nox in The", True) == "The IP of x"  # a plural may follow; inside a longer word nothing is found
    assert alignment.restore_case("ip x", "IPs X", True) == "IP X"
    assert alignment.restore_case("ip x", "IPs X", False) == "ip X"


def test_bpe_learn_and_apply():
    codes = subword.learn_from({"low": 5, "lower": 2, "newest": 6, "widest": 3}, 10)
    assert codes[0] == ("e", "s") and codes[1] == ("es", "t</w>")
    enc = subword.Encoder(codes)
    for w in ("low", "newest", "unseen"):
        assert enc.line(w).replace("@@ ", "") == w
    assert subword.merged(list("aaaa"), ("a", "a")) == ["aa", "aa"]


def test_case_is_of_single_characters(spark):
    df = spark.createDataFrame([("ßa",), ("ŉa",), ("ᾳa",), ("éa",)], "v string")
    assert [r[0] for r in df.select(lines.get("en", "Capitalize")(F.col("v"))).collect()] == ["ẞa", "ŉa", "ᾼa", "Éa"]
    low = spark.createDataFrame([("ÀİΟΔΟΣ",)], "v string").select(lines.get("common", "To_Lower")(F.col("v"))).first()[0]
    assert low == "àiοδοσ"


def test_white_space_and_allowed_classes_hold_for_every_character(spark):
    from lexmill.functions import chars
    from lexmill.functions.regex import strip, tokens

    points = [c for c in range(1, 0x3400) if c < 0xD800] + [0xFF00, 0xFFE0, 0xFFFF, 0x1F600, 0x20000]
    df = spark.createDataFrame([(c, f"a{chr(c)}b{chr(c)}") for c in points], "c int, v string")
    v, s = F.col("v"), f"[{chars.STRIPPED}]+"
    bad = f"[^{chars.ALLOWED.replace('[', chr(92) + '[')}]| "
    same = (strip(v) == F.regexp_replace(v, f"^{s}|{s}$", "")) & (tokens(v) == F.filter(F.split(v, s), lambda w: w != "")) & (lines.is_allowed(v) == ~F.regexp_replace(v, f"^{s}|{s}$", "").rlike(bad))
    assert df.where(~same).count() == 0
    assert "regexp_replace" not in df.select(strip(v))._jdf.queryExecution().optimizedPlan().toString()
