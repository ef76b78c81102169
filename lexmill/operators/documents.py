"""JSON documents: texts out of them, sentences into them, records for a search index, search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexmill.functions.regex import tokens

ORIGINAL = "struct<date:string,lang:string,source:string,categories:array<string>,tags:array<string>,structured_content:struct<title:string,author:string,publication_date:string>,paragraphs:array<string>>"
PROCESSED = "struct<date:string,processed_method:string,paragraphs:array<struct<sentences:array<string>>>>"
TRANSLATED = "array<struct<lang:string,date:string,engine:string,model:string,score:float,paragraphs:array<struct<sentences:array<struct<score:float,text:string,text_unk:string>>>>>>"
DOCUMENT = f"struct<original_doc:{ORIGINAL},processed_doc:{PROCESSED},translated_docs:{TRANSLATED}>"


def extract_text(docs: DataFrame, value: str = "value") -> DataFrame:
    """Adds text (the paragraphs, a line each) and meta (the document as JSON without them). A bare document is wrapped."""
    whole = F.from_json(value, DOCUMENT)
    original = F.coalesce(whole["original_doc"], F.from_json(value, ORIGINAL))
    out = docs.withColumn("_o", original)
    return out.withColumns({"text": F.array_join(F.coalesce(F.col("_o.paragraphs"), F.array().cast("array<string>")), "\n"), "meta": F.to_json(F.struct(F.col("_o").dropFields("paragraphs").alias("original_doc")))}).drop("_o")


def paragraphs_of_sentences(lines: DataFrame, doc: str = "doc_id", position: str = "line_no", value: str = "value") -> DataFrame:
    """doc, paragraphs: array of struct(sentences); blank lines part paragraphs, the last needs none after it."""
    blank = F.trim(F.coalesce(value, F.lit(""))) == ""
    island = F.sum(blank.cast("int")).over(Window.partitionBy(doc).orderBy(position).rowsBetween(Window.unboundedPreceding, 0))
    own = lines.withColumn("_b", blank).withColumn("_i", island).where("not _b")
    each = own.groupBy(doc, "_i").agg(F.sort_array(F.collect_list(F.struct(position, F.col(value).alias("v")))).alias("_l"))
    para = F.struct(F.col("_i"), F.transform("_l", lambda e: e["v"]).alias("sentences"))
    return each.groupBy(doc).agg(F.sort_array(F.collect_list(para)).alias("_p")).select(doc, F.transform("_p", lambda p: F.struct(p["sentences"].alias("sentences"))).alias("paragraphs"))


def index_record(paragraphs: Column, method: str = "unknown", date: Column | None = None) -> Column:
    """The processed part of a document as JSON."""
    when = date if date is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.to_json(F.struct(F.struct(F.lit(method).alias("processed_method"), when.alias("date"), paragraphs.alias("paragraphs")).alias("processed_doc")))


def document_from_lines(lines: DataFrame, doc: str = "doc_id", position: str = "line_no", value: str = "value", lang: str = "en", categories: tuple[str, ...] = ("finance", "news")) -> DataFrame:
    """doc, json: non-blank lines as the paragraphs of a new document."""
    own = lines.where(F.trim(F.coalesce(value, F.lit(""))) != "")
    body = own.groupBy(doc).agg(F.sort_array(F.collect_list(F.struct(position, F.col(value).alias("v")))).alias("_l"))
    return body.select(doc, F.to_json(F.struct(F.struct(F.lit(lang).alias("lang"), F.array(*map(F.lit, categories)).alias("categories"), F.transform("_l", lambda e: e["v"]).alias("paragraphs")).alias("original_doc"))).alias("json"))


def record_id(source: Column) -> Column:
    """URL-safe base64 of the source, in one piece: Spark breaks it into rows of 76 characters."""
    return F.translate(F.base64(source.cast("binary")), "+/\r\n", "-_")


def byte_batches(lines: DataFrame, limit: int = 3000, group: str = "doc_id", position: str = "line_no", value: str = "value") -> DataFrame:
    """Adds batch: consecutive lines of a group in batches that start where the running size crosses ``limit`` bytes."""
    running = F.sum(F.octet_length(F.coalesce(value, F.lit(""))) + 1).over(Window.partitionBy(group).orderBy(position).rowsBetween(Window.unboundedPreceding, 0))
    return lines.withColumn("batch", F.floor((running - 1) / limit))


def not_done(lines: DataFrame, done: DataFrame, value: str = "value") -> DataFrame:
    """Lines whose text is not among those already translated."""
    return lines.join(done.select(value).distinct(), value, "left_anti")


def search(sentences: DataFrame, query: str, n: int = 10, operator: str = "OR", key: str = "sent_id", value: str = "value", k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """key, value, score: the n most relevant sentences (BM25 over lower-cased words; ties by key)."""
    terms = sorted(set(query.lower().split()))
    own = sentences.select(key, value, tokens(F.lower(value)).alias("_w"))
    stats = own.agg(F.count("*").alias("_n"), F.avg(F.size("_w")).alias("_avg"), *(F.sum(F.array_contains("_w", t).cast("int")).alias(f"_df{i}") for i, t in enumerate(terms)))
    joined = own.crossJoin(F.broadcast(stats))  # one row of statistics
    score, hits = F.lit(0.0), F.lit(0)
    for i, t in enumerate(terms):
        tf = F.size("_w") - F.size(F.array_remove("_w", t))
        idf = F.ln(1 + (F.col("_n") - F.col(f"_df{i}") + 0.5) / (F.col(f"_df{i}") + 0.5))
        score = score + idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.size("_w") / F.col("_avg")))
        hits = hits + (tf > 0).cast("int")
    need = len(terms) if operator.upper() == "AND" else 1
    return joined.where(hits >= need).select(key, value, score.alias("score")).orderBy(F.desc("score"), key).limit(n)
