"""JSON pipeline specifications compiled to one lazy plan.

A specification has ``steps`` (name, type, inputs, outputs, rules, replace_empty_line, disable), ``inputs``,
``final_outputs`` and ``startover``. Names of files are names of tables with line_no and value. Consecutive line rules are
one projection. Rules are looked up in a registry, never evaluated: ``prefix.Name``, where a prefix ending in ``_en`` or
``_zh`` names the language; a parameter that a rule doesn't have is an error, and one that names a file of words, of
key-value pairs or of merges is read as a table (at most ``WORDS`` lines, since such lists travel inside the plan).

Rules that order lines (``Sort``, ``Cut_Lines`` ...) run a few jobs while the plan is built: quantile bounds, a count. With
``spark.checkpoint.dir`` set their input is checkpointed there, so that it is evaluated once.
"""

from __future__ import annotations

import argparse
import inspect
import json
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators import alignment, documents, lines, replacer, scoring, segmenter, slots, subword, tables, tokenizer  # noqa: F401  (they register rules)
from lexmill.operators.lines import Line, chain


class SpecError(ValueError):
    pass


#: The most lines of a file that a parameter names.
WORDS = 1_000_000
#: Rule and parameter that name a file: the operator's parameter, and what the lines are.
NAMED = {
    ("Replace_Words_Per_Dict", "dictfile"): ("words", "words"), ("Replace_Lower_Char_To_Upper_Word_Line", "upperCharWord"): ("words", "words"), ("Find_Word_Entity", "word_dict"): ("table", "pairs"),
    ("BD_Break_Line", "voc"): ("voc", "words"), ("BPE_Apply", "code"): ("codes", "merges"), ("BPE_Apply_Line", "code"): ("codes", "merges"),
}
#: Parameters of the format that choose between implementations this library has one of.
IGNORED = {"mode", "script", "model", "user_dict"}


@dataclass
class Step:
    name: str
    type: str
    rules: list
    inputs: list[str] = field(default_factory=list)
    outputs: list[str] = field(default_factory=list)
    replace_empty_line: str = ""
    disable: bool = False


def language_of(name: str) -> tuple[str, str]:
    prefix, _, own = name.rpartition(".")
    return ("en" if prefix.endswith("_en") else "zh" if prefix.endswith("_zh") else "common"), own


def load(spec: str | Mapping) -> Mapping:
    """A mapping, JSON text, or the path of a JSON file."""
    if isinstance(spec, Mapping):
        return spec
    if spec.lstrip().startswith("{"):
        return json.loads(spec)
    with open(spec, encoding="utf-8") as f:
        return json.load(f)


def steps_of(spec: Mapping) -> list[Step]:
    out = []
    for s in spec.get("steps", []):
        kind = s.get("type")
        if kind not in {"line", "file", "sole_line", "context"}:
            raise SpecError(f"step {s.get('name')!r}: unknown type {kind!r}")
        if kind in {"line", "file"} and not ("inputs" in s and "outputs" in s):
            raise SpecError(f"step {s.get('name')!r}: inputs and outputs are required")
        if kind == "line" and ("replace_empty_line" not in s or len(s["inputs"]) != 1 or len(s["outputs"]) != 2):
            raise SpecError(f"line step {s.get('name')!r}: one input, two outputs and replace_empty_line are required")
        out.append(Step(s.get("name", ""), kind, s.get("rules", []), list(s.get("inputs", [])), list(s.get("outputs", [])), s.get("replace_empty_line", ""), bool(s.get("disable", 0))))
    return out


# --- line steps -------------------------------------------------------------------------------------------------------


def line_rules(rules: Sequence, services: Mapping | None = None, table: Callable[[str], DataFrame] | None = None) -> Line:
    """One expression for a list of [name, parameters]. Neighbouring equal space collapses are built once."""
    built, last = [], None
    for name, params in rules:
        _, own = language_of(name)
        if own == last == "Remove_Redundant_Spaces":
            continue
        built.append(line_rule(name, params, services, table))
        last = own
    return chain(built)


def line_rule(name: str, params: Mapping, services: Mapping | None = None, table: Callable[[str], DataFrame] | None = None) -> Line:
    language, own = language_of(name)
    build = lines.REGISTRY.get((language, own)) or lines.REGISTRY.get(("common", own))
    if build is None:
        raise KeyError(f"no line operator {own!r} for {language!r}")
    given = {}
    for k, v in params.items():
        v = bound(v, services)
        if (own, k) in NAMED:
            k, kind = NAMED[own, k]
            v = listed(table, v, kind)
        given[k] = v
    if own == "BD_Break_Line" and "entity_safe" in given:
        given["entity_safe"] = truth(given["entity_safe"])
    return build(**checked(name, build.factory, given))


def checked(name: str, f: Callable, params: Mapping) -> Mapping:
    """The parameters that ``f`` takes; an unknown or missing one is an error."""
    known = inspect.signature(f).parameters
    own = {k: v for k, v in params.items() if k in known or k not in IGNORED}
    try:
        inspect.signature(f).bind(**own)
    except TypeError as e:
        raise SpecError(f"{name}: {e}") from None
    return own


def truth(v) -> bool:
    return v.lower() == "true" if isinstance(v, str) else bool(v)


def listed(table: Callable[[str], DataFrame] | None, v, kind: str):
    """The lines of the table or tables that ``v`` names; a list of words, a mapping or a list of merges stays."""
    names = [v] if isinstance(v, str) else v
    if not isinstance(names, Sequence) or not names or not all(isinstance(n, str) for n in names) or table is None:
        return v
    rows = [r["value"] for n in names for r in table(n).where("value is not null").orderBy("line_no").select("value").limit(WORDS + 1).collect()]
    if len(rows) > WORDS:
        raise SpecError(f"{names}: more than {WORDS} lines; join a table of this size (lexmill.operators.tables)")
    if kind == "words":
        return [w for r in rows if (w := r.strip())]
    if kind == "pairs":
        return {f[0].strip(): f[1].strip() for r in rows if len(f := r.split("\t")) > 1}
    return [tuple(f) for r in rows if len(f := r.split()) == 2 and not r.startswith("#")]


def bound(v, services: Mapping | None):
    return services[v[2:]] if isinstance(v, str) and v.startswith("$$") and services and v[2:] in services else v


def run_line_step(df: DataFrame, operator: Line, token: str = "") -> tuple[DataFrame, DataFrame]:
    """kept and removed. With a token, dropped lines stay as the token, so rows keep their alignment; removed lines are
    ``number TAB original``."""
    line = F.regexp_replace("value", r"^[\r\n]+|[\r\n]+$", "")
    own = df.select("line_no", F.col("value").alias("_original"), operator(line).alias("value"))
    if token:
        kept = own.select("line_no", F.coalesce("value", F.lit(token)).alias("value"))
    else:  # exploding what is left evaluates the chain once; a filter beside a projection would do so twice
        raw = getattr(operator, "raw", operator)
        kept = df.select("line_no", F.explode(F.filter(F.array(raw(line)), lambda x: x != "")).alias("value"))
    removed = own.where("value is null").select("line_no", F.concat_ws("\t", F.col("line_no").cast("string"), F.coalesce("_original", F.lit(""))).alias("value"))
    return kept, removed


# --- file steps -------------------------------------------------------------------------------------------------------

Tables = list[DataFrame]
FILE_RULES: dict[str, Callable[..., Tables]] = {}


def file_rule(*names: str):
    def add(f):
        for n in names:
            FILE_RULES[n] = f
        return f

    return add


def lines_only(df: DataFrame, value: Column | str = "value") -> DataFrame:
    return df.select("line_no", (F.col(value) if isinstance(value, str) else value).alias("value"))


def renumbered(df: DataFrame, keys: Sequence[tuple[Column, bool]]) -> DataFrame:
    return dense(tables.numbered(settled(df.select("value")), keys).select("line_no", "value"))


@file_rule("Sort")
def _sort(ctx, inputs, reverse=0, num_sort=0):
    down = bool(int(reverse))
    keys = [(tables.leading_number(F.col("value")), down)] if int(num_sort) else []
    return [renumbered(inputs[0].select("value"), [*keys, (F.col("value"), down)])]


@file_rule("Uniq")
def _uniq(ctx, inputs):
    """Drops lines equal to the one before. Right behind a sort that is a grouping by line; else lines meet the one
    before by its position."""
    if ctx.last == "Sort":
        return [inputs[0].groupBy("value").agg(F.min("line_no").alias("line_no")).select("line_no", "value")]
    own = ordinal(inputs[0])
    before = own.select((F.col("line_no") + 1).alias("line_no"), F.col("value").alias("_before"), F.lit(True).alias("_some"))
    return [own.join(before, "line_no", "left").where(F.col("_some").isNull() | ~F.col("value").eqNullSafe(F.col("_before"))).select("line_no", "value")]


@file_rule("Cut_Lines")
def _cut(ctx, inputs, start=0, end=0):
    if not 1 <= int(start) <= int(end):
        raise SpecError("Cut_Lines: 1 <= start <= end is required")
    n = ordinal(inputs[0])
    return [dense(n.where(F.col("line_no").between(int(start), int(end))).select((F.col("line_no") - (int(start) - 1)).alias("line_no"), "value"))]


def dense(df: DataFrame) -> DataFrame:
    """Remembers that the positions of ``df`` are 1 to n."""
    _dense[df] = True
    return df


_dense: WeakKeyDictionary[DataFrame, bool] = WeakKeyDictionary()


def settled(df: DataFrame) -> DataFrame:
    """Evaluated once where the session names a folder for checkpoints."""
    return df.checkpoint() if df.sparkSession.conf.get("spark.checkpoint.dir", None) else df


def ordinal(df: DataFrame) -> DataFrame:
    """Positions made dense again after lines were dropped; a table known to be dense stays as it is."""
    if df in _dense:
        return df
    return dense(tables.numbered(settled(df).withColumnRenamed("line_no", "_was"), [(F.col("_was"), False)]).select("line_no", "value"))


@file_rule("Insert_Line")
def _insert(ctx, inputs, line_num=1, content=""):
    n = ordinal(inputs[0]) if int(line_num) > 1 else inputs[0]
    out = tables.insert_line(n, int(line_num), content)
    return [dense(out) if int(line_num) == 1 and n in _dense else out]


@file_rule("Replace_Content")
def _replace(ctx, inputs, pattern, repl):
    return [lines_only(inputs[0], lines.replace(F.col("value"), pattern, repl, False))]


@file_rule("Remove_Lines_With_Content")
def _remove(ctx, inputs, content=""):
    return [inputs[0].where(~lines.contains(F.col("value"), content)) if content else inputs[0]]


@file_rule("Shuffle_Single")
def _shuffle(ctx, inputs, seed=1):
    return [renumbered(inputs[0], [(F.xxhash64(F.lit(int(seed)), "value"), False), (F.col("value"), False)])]


@file_rule("Remove_Add_Line_Char")
def _remove_separator(ctx, inputs):
    return [lines_only(inputs[0], F.translate("value", "\u2028", ""))]


@file_rule("Split_To_Twin_Files")
def _split(ctx, inputs, delim="\t"):
    t = tables.split_twin(inputs[0], delim=delim)
    same = dense if inputs[0] in _dense else lambda x: x
    return [same(lines_only(t, "left")), same(lines_only(t, "right"))]


@file_rule("Split_To_Twin_Files_v2")
def _split_strict(ctx, inputs, delim="\t"):
    t = tables.split_twin_strict(inputs[0])
    return [lines_only(t, "left"), lines_only(t, "right")]


@file_rule("Split_To_Twin_Files_v3")
def _split_clean(ctx, inputs, delim="\t"):
    t = tables.split_twin_clean(inputs[0])
    return [lines_only(t, "left"), lines_only(t, "right")]


@file_rule("Combine_Twin_Files")
def _combine(ctx, inputs, delim="\t"):
    return [tables.combine_twin(inputs[0], inputs[1], delim=delim).select("line_no", "value")]


@file_rule("Group_Lines_With_Tags_If_Exist")
def _group(ctx, inputs, tags):
    return [tables.group_with_tags(list(zip(tags, inputs)))]


@file_rule("Select_Input")
def _select_input(ctx, inputs, input):
    return [ctx.table(n) for n in input]


@file_rule("Select_Output")
def _select_output(ctx, inputs, index, output=None):
    """The inputs at these places (from 0), named for later steps where ``output`` has names."""
    if output and len(output) != len(index) or not all(0 <= int(i) < len(inputs) for i in index):
        raise SpecError(f"Select_Output: index {index} of {len(inputs)} inputs, output {output}")
    got = [inputs[int(i)] for i in index]
    ctx.tables |= zip(output or [], got)
    return got


@file_rule("Statistic_Word_Vocab")
def _vocab(ctx, inputs, skip_words=""):
    counts = tables.word_counts(inputs[0], skip_words=[w for w in skip_words.split("|") if w])
    return [renumbered(counts.select(F.concat_ws("\t", F.col("freq").cast("string"), "word").alias("value")), [(F.col("value"), False)])]


@file_rule("Statistic_Character_Set")
def _characters(ctx, inputs):
    counts = tables.character_counts(inputs[0])
    return [renumbered(counts.select(F.concat_ws("\t", F.col("freq").cast("string"), "char").alias("value")), [(F.col("value"), False)])]


def vocab_table(df: DataFrame) -> DataFrame:
    return df.select((F.col("line_no") - 1).alias("id"), F.trim("value").alias("word"))


@file_rule("Words_To_Tokens")
def _ids(ctx, inputs):
    return [tables.words_to_ids(inputs[0], vocab_table(ordinal(inputs[1])), ["line_no"])]


@file_rule("Words_To_Tokens_V2")
def _ids_v2(ctx, inputs, voc):
    return [tables.words_to_ids(inputs[0], vocab_table(ordinal(ctx.table(voc))), ["line_no"])]


@file_rule("Tokens_To_Words")
def _words(ctx, inputs):
    """The vocabulary becomes a literal list; ``tables.words_to_ids`` has the join for the other way."""
    words = [r["value"].strip() for r in ordinal(inputs[1]).orderBy("line_no").select("value").limit(1_000_001).collect()]
    if len(words) > 1_000_000:
        raise SpecError("Tokens_To_Words: more than a million words")
    return [tables.ids_to_words(inputs[0], words)]


@file_rule("BD_Break")
def _break(ctx, inputs, voc, entity_safe="false"):
    return [tables.break_unknown_words(inputs[0], ctx.table(voc).select(F.trim("value").alias("word")), ["line_no"], entity_safe=truth(entity_safe))]


def _prob_rows(df: DataFrame) -> DataFrame:
    f = F.split("value", "\t")
    return df.where(F.size(f) >= 3).select("line_no", F.get(f, 0).alias("lw"), F.get(f, 1).alias("rw"), F.get(f, 2).cast("double").alias("logp"))


@file_rule("WordProb_To_PKL")
def _prob_lists(ctx, inputs):
    """lw and words as a table with a JSON value a row."""
    t = tables.probability_lists(_prob_rows(inputs[0]))
    return [renumbered(t.select(F.to_json(F.struct("lw", "words")).alias("value")), [(F.col("value"), False)])]


@file_rule("WordProb_To_PKL_v2")
def _prob_maps(ctx, inputs):
    t = tables.probability_maps(_prob_rows(inputs[0]))
    return [renumbered(t.select(F.to_json(F.struct("lw", "probs")).alias("value")), [(F.col("value"), False)])]


@file_rule("WordList_To_PKL")
def _word_list(ctx, inputs):
    return [lines_only(inputs[0], F.trim("value"))]


@file_rule("Fast_Align")
def _fast_align(ctx, inputs, rounds=5):
    """The word table (lw, rw, log p) and the links of ``src ||| tgt`` lines."""
    from lexmill.operators import aligner

    f = F.split("value", r" \|\|\| ")
    pairs = inputs[0].where(F.size(f) == 2).select(F.col("line_no").alias("pair_id"), F.get(f, 0).alias("src"), F.get(f, 1).alias("tgt"))
    t = aligner.word_table(pairs, int(rounds))
    table = t.select(F.concat_ws("\t", "lw", "rw", F.ln("p").cast("string")).alias("value"))
    return [renumbered(table, [(F.col("value"), False)]), aligner.own_links(pairs, int(rounds)).select(F.col("pair_id").alias("line_no"), F.col("links").alias("value"))]


@file_rule("Bleu", "BleuGeneratorAirflow")
def _bleu(ctx, inputs, reference=None):
    """Hypothesis and reference are two inputs, or the reference is named."""
    ref = ctx.table(reference) if reference else inputs[1]
    of = lambda d: d.select(F.col("line_no").alias("sent_id"), "value")
    return [scoring.bleu_report(of(inputs[0]), of(ref)).select(F.col("order").alias("line_no"), "value")]


@file_rule("Tidy_Translated_Result")
def _tidy(ctx, inputs):
    return [tables.file_paragraphs(settled(inputs[0]))]


@file_rule("Segment_EN_Doc_To_Sentences", "Segment_EN_lines_To_Sentences")
def _sentences(ctx, inputs):
    """One sentence a line, a blank line after each paragraph."""
    s = F.concat(F.coalesce(tokenizer.english_sentences(F.col("value")), F.array().cast("array<string>")), F.array(F.lit("")))
    return [ordinal_of(inputs[0].select("line_no", F.posexplode(s).alias("at", "value")))]


@file_rule("Segment_ZH_Doc_To_Sentences")
def _chinese(ctx, inputs):
    return [ordinal_of(inputs[0].select("line_no", F.posexplode(tokenizer.chinese_sentences(F.col("value"))).alias("at", "value")))]


def ordinal_of(df: DataFrame) -> DataFrame:
    return tables.numbered(df.withColumnRenamed("line_no", "_was"), [(F.col("_was"), False), (F.col("at"), False)]).select("line_no", "value")


@file_rule("Remove_Length_Not_Balanced_Pair")
def _balanced(ctx, inputs, min_ratio=0.5, max_ratio=2.0, left_mode="word", right_mode="word"):
    f = tables.fields()
    two = inputs[0].withColumns({"left": F.when(F.size(f) == 2, F.get(f, 0)), "right": F.when(F.size(f) == 2, F.get(f, 1))})
    return [lines_only(tables.length_balanced(two, min_ratio=float(min_ratio), max_ratio=float(max_ratio), left_mode=left_mode, right_mode=right_mode).where("balanced"))]


@file_rule("Filter_Sentence_With_Illegal_Chars")
def _allowed(ctx, inputs):
    ok = lines.is_allowed(F.col("value"))
    return [inputs[0].where(ok), inputs[0].where(~ok)]


@file_rule("Generate_Entity_Word_Dict")
def _entities(ctx, inputs, word_entity, baidu_word_entity, google_word_entity):
    t = tables.three_way_dictionary(*(ctx.table(n) for n in (word_entity, baidu_word_entity, google_word_entity)))
    return [lines_only(t, F.concat_ws("\t", "word", "translation"))]


@file_rule("Replace_Lower_Char_To_Upper_Word")
def _case(ctx, inputs, upperCharWord=(), source_text=None):
    words = listed(ctx.table, list(upperCharWord), "words")
    both = inputs[0].join(ctx.table(source_text).select("line_no", F.col("value").alias("_s")), "line_no")
    return [lines_only(both, lines.restore_case_from(F.col("value"), F.col("_s"), words))]


@file_rule("Extract_Text_From_Raw_Doc")
def _extract(ctx, inputs):
    """The paragraphs as lines, and the rest as JSON."""
    t = documents.extract_text(inputs[0])
    return [ordinal_of(t.select("line_no", F.posexplode(F.split("text", "\n")).alias("at", "value"))), lines_only(t, "meta")]


@file_rule("Create_ES_Data_Type_transdoc")
def _record(ctx, inputs, processed_method="unknown"):
    p = documents.paragraphs_of_sentences(inputs[0].withColumn("doc_id", F.lit(0)))
    return [p.select(F.col("doc_id").cast("long").alias("line_no"), documents.index_record(F.col("paragraphs"), processed_method).alias("value"))]


@file_rule("Create_Orig_Json_From_Text")
def _json(ctx, inputs):
    d = documents.document_from_lines(inputs[0].withColumn("doc_id", F.lit(0)))
    return [d.select(F.col("doc_id").cast("long").alias("line_no"), F.col("json").alias("value"))]


@file_rule("Translate")
def _translate(ctx, inputs, **params):
    """Any translator is a client the caller provides: ``services={"translate": function}``."""
    from lexmill.sources import translated

    client = (ctx.services or {}).get("translate")
    if client is None:
        raise SpecError("no translation client: pass services={'translate': function}")
    return [lines_only(translated(inputs[0], client), "translation")]


@file_rule("Create_ES_Index_If_No_Exists")
def _create_index(ctx, inputs, host="", index="", type=""):
    """The caller's client creates the index from the mapping in the input unless it is there:
    ``services={"create_index": function(host, index, type, mapping)}``."""
    client = (ctx.services or {}).get("create_index")
    if client is None:
        raise SpecError("no index client: pass services={'create_index': function}")
    mapping = "\n".join(r["value"] for r in inputs[0].orderBy("line_no").limit(10_000).collect()) if inputs else ""
    client(host, index, type, mapping)
    return inputs[:1]


@file_rule("Index_to_ElasticSearch")
def _index(ctx, inputs, host="", index="", type=""):
    """Documents with their record ids; writing them is the sink's work (``sources.index_sink``)."""
    source = F.get_json_object("value", "$.original_doc.source")
    return [inputs[0].select("line_no", F.to_json(F.struct(documents.record_id(F.coalesce(source, F.lit(""))).alias("id"), F.col("value").alias("doc"))).alias("value"))]


@file_rule("Run_Schema")
def _nested(ctx, inputs, schema, generator=None, rerun=0):
    """Without a generator the sub-specification over the inputs. With ``Generator_Loop_File_List`` the input lists files:
    the sub-specification runs for each that exists, its results are written under the work directory in a folder of the
    file's name (with ``rerun`` 0 and ``startover`` 0 results that are there stay), and the two outputs list the files done
    and the files failed, each with its folder. A failure doesn't end the run."""
    if generator is None:
        sub = Engine(ctx.spark, schema, services=ctx.services, workdir=ctx.workdir)
        return list(sub.run(dict(zip(sub.inputs, inputs))).values())
    if generator.rpartition(".")[2] != "Generator_Loop_File_List":
        raise SpecError(f"Run_Schema: unknown generator {generator!r}")
    if ctx.workdir is None:
        raise SpecError("Run_Schema over a list of files writes its results: the engine needs a workdir")
    from lexmill.sources import existing, text_lines

    done, failed = [], []
    for name in existing(ctx.spark, [r["value"].strip() for r in inputs[0].orderBy("line_no").collect() if r["value"].strip()]):
        folder = f"{ctx.workdir}/{name.rstrip('/').rpartition('/')[2]}"
        try:
            sub = Engine(ctx.spark, schema, services=ctx.services, workdir=folder)
            sub.write({sub.inputs[0]: text_lines(ctx.spark, name).select("line_no", "value")}, again=bool(int(rerun)) or None)
            done.append(f"{name}\t{folder}")
        except Exception as e:
            failed.append(f"{name}\t{folder}\t{type(e).__name__}")
    return [ctx.spark.createDataFrame(list(enumerate(x, 1)), "line_no long, value string") for x in (done, failed)]


# --- the engine -------------------------------------------------------------------------------------------------------


class Engine:
    """``run`` compiles file pipelines, ``line`` gives a library chain, ``context`` applies a context pipeline."""

    def __init__(self, spark: SparkSession, spec: str | Mapping, services: Mapping | None = None, workdir: str | None = None):
        self.spark, self.spec, self.services, self.workdir, self.last = spark, load(spec), services or {}, workdir, ""
        self.steps = [s for s in steps_of(self.spec) if not s.disable]
        self.inputs = list(self.spec.get("inputs") or (self.steps[0].inputs if self.steps else []))
        self.final_outputs = list(self.spec.get("final_outputs") or [])
        named = {o for s in self.steps for o in s.outputs} | {o for s in self.steps if s.type == "file" for _, p in s.rules for o in p.get("output") or []} | set(self.inputs)
        if missing := [o for o in self.final_outputs if o not in named]:
            raise SpecError(f"no step makes the final outputs {missing}")
        self.tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self.tables:
            from lexmill.sources import text_lines

            self.tables[name] = text_lines(self.spark, name).select("line_no", "value")
        return self.tables[name]

    def run(self, inputs: Mapping[str, DataFrame] | None = None) -> dict[str, DataFrame]:
        """name -> table of every final output (all outputs where the specification names none). Lazy."""
        self.tables = dict(inputs or {})
        made: dict[str, DataFrame] = {}
        for s in self.steps:
            if s.type == "line":
                out: Tables = list(run_line_step(self.table(s.inputs[0]), line_rules(s.rules, self.services, self.table), s.replace_empty_line))
            elif s.type == "file":
                out, self.last = [self.table(n) for n in s.inputs], ""
                for name, params in s.rules:
                    out = self._file_rule(name, out, params)
                    self.last = language_of(name)[1]
                if len(out) != len(s.outputs):
                    raise SpecError(f"step {s.name!r}: {len(out)} results for {len(s.outputs)} outputs")
            else:
                raise SpecError(f"step {s.name!r}: {s.type} steps have no files")
            made |= zip(s.outputs, out)
            self.tables |= zip(s.outputs, out)
        return {n: self.tables[n] for n in self.final_outputs or [n for n in made if n != "_"]}

    def write(self, inputs: Mapping[str, DataFrame], again: bool | None = None) -> bool:
        """Runs and writes the final outputs as text under the work directory. Without ``again`` the specification's
        ``startover`` decides; where it is 0 and all results are there, nothing is run. True if it ran."""
        from lexmill.sources import existing, write_lines

        again = bool(int(self.spec.get("startover", 1))) if again is None else again
        paths = [f"{self.workdir}/{n}" for n in self.final_outputs]
        if not again and paths and len(existing(self.spark, paths)) == len(paths):
            return False
        for name, t in self.run(inputs).items():
            write_lines(t.orderBy("line_no"), f"{self.workdir}/{name}")
        return True

    def _file_rule(self, name: str, inputs: Tables, params: Mapping) -> Tables:
        language, own = language_of(name)
        params = {k: bound(v, self.services) for k, v in params.items()}
        own = "Translate" if own.startswith("Translate_") else own  # every translator is the caller's client
        if own in FILE_RULES:
            takes = inspect.signature(FILE_RULES[own]).parameters
            own_params = {k: v for k, v in params.items() if k in takes or k not in IGNORED or "params" in takes}
            try:
                inspect.signature(FILE_RULES[own]).bind(self, inputs, **own_params)
            except TypeError as e:
                raise SpecError(f"{name}: {e}") from None
            return FILE_RULES[own](self, inputs, **own_params)
        operator = line_rule(name, params, self.services, self.table)  # a line rule over a whole table
        return [d.select("line_no", operator(F.col("value")).alias("value")) for d in inputs[:1]]

    def line(self) -> Line:
        """The library form: all steps as one operator for lines of any table."""
        return chain([line_rules(s.rules, self.services, self.table) for s in self.steps if s.type in {"sole_line", "line"}])

    def context(self, df: DataFrame) -> DataFrame:
        """Context rules over rows: parameters ``$$name`` are columns, a falsy result leaves the old value."""
        for s in self.steps:
            for r in s.rules:
                df = self._context_rule(df, r["name"], r.get("init_args") or {}, r.get("run_params") or {}, r.get("run_outputs") or [])
        return df

    def _context_rule(self, df: DataFrame, name: str, init: Mapping, params: Mapping, outputs: Sequence[str]) -> DataFrame:
        language, own = language_of(name)
        init = {k: bound(v, self.services) for k, v in init.items() if not (isinstance(v, str) and v.startswith("$$") and v[2:] not in self.services)}
        at = {k: F.col(v[2:]) if isinstance(v, str) and v.startswith("$$") else F.lit(v) for k, v in params.items()}
        new: list[Column]
        if own == "Align_Sentence_Detokenizer":
            on = at["align_enabled"] & (F.size(at["tgt_origin"]) > 0) & (F.size(at["src_origin"]) > 0)
            new = [F.when(on, tokenizer.detokenize_array(at[k], init.get("lang", "en"))) for k in ("tgt_origin", "src_origin")]
        elif own == "Align_Target_Source":
            got = alignment.align_columns(at["align_enabled"], at["tgt_array"], at["src_array"], at["tgt_src_mapping"], bool(init.get("append_space", False)))
            df = df.withColumn("_aligned", got)
            new = [F.col("_aligned.target"), F.col("_aligned.source"), F.col("_aligned.mapping")]
        elif own == "Correct_En_Word_Case":
            new = [alignment.correct_case(at["line"], at["raw_line"])]
        elif own == "Align_Correct_En_Word_Case":
            new = [alignment.correct_case_array(at["align_enabled"], at["line"], at["raw_line"], plural=language == "zh")]
        elif own == "Segment_EN_lines_To_Sentences":
            new = [tokenizer.english_sentences(at["line"])]
        else:
            if own in {"BPE_Apply_Line", "Pre_Replacing_Rule", "Post_Replacing_Rule"}:
                init = {k: v for k, v in init.items() if k in {"code", "codes", "separator", "whole", "rules"}} | self.services.get(own, {})
            new = [line_rule(name, init, self.services, self.table)(at["line"])]
        kinds = dict(df.dtypes)
        for o, c in zip(outputs, new):
            truthy = F.size(c) > 0 if kinds.get(o, "").startswith("array") or own.startswith("Align") else F.length(c) > 0
            df = df.withColumn(o, F.coalesce(F.when(truthy, c), F.col(o)) if o in kinds else F.when(truthy, c))
        return df.drop("_aligned")


def main(argv: Sequence[str] | None = None) -> None:
    """spark-submit entry: ``--infiles A B --schema FILE --workdir DIR``. Final outputs are written as text under the work
    directory; with ``startover`` 0 results that exist stay."""
    p = argparse.ArgumentParser()
    p.add_argument("--infiles", nargs="*", default=[])
    p.add_argument("--schema", required=True)
    p.add_argument("--workdir", required=True)
    a = p.parse_args(argv)
    from lexmill.sources import text_lines

    began = time.time()
    spark = SparkSession.builder.appName("lexmill").getOrCreate()
    engine = Engine(spark, a.schema, workdir=a.workdir)
    ran = engine.write({n: text_lines(spark, f).select("line_no", "value") for n, f in zip(engine.inputs, a.infiles or engine.inputs)})
    print(f"took {time.time() - began:.1f} s" if ran else "all final outputs are there: nothing to do")


if __name__ == "__main__":
    main()
