"""Registered queries of the core over the test tables, and their SQL.

Every query runs over its whole tables. A query without SQL is one that SQL cannot express; its operator is tested on
fixtures against a plain version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from linepress.functions import text as T
from linepress.operators import align, catalog, dedupe, external, langid, repair, rules, sampling, shards, spans, stats, tags
from linepress.plans import oracle
from linepress.plans.pipeline import Commands, run
from linepress.session import broadcast_if_small, fresh_path, spread
from linepress.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]
S, G = "source_segment", "target_segment"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of all datasets, a null side as '', with the language codes of their catalog row ('' where it has none)."""
    ds = table(spark, sf_dir, "datasets").select("ds", F.coalesce(T.code_of("src_lang"), F.lit("")).alias("src_lang"), F.coalesce(T.code_of("tgt_lang"), F.lit("")).alias("tgt_lang"))
    b = spread(table(spark, sf_dir, "bifixer")).select("pair_id", "ds", "line_no", F.coalesce(S, F.lit("")).alias(S), F.coalesce(G, F.lit("")).alias(G))
    return b.join(broadcast_if_small(ds), "ds", "left").na.fill("", ["src_lang", "tgt_lang"])


def doc_lines(spark: SparkSession, sf_dir: str, kind: str | None = None) -> DataFrame:
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "doc_kind", "text"))
    if kind:
        d = d.filter(F.col("doc_kind") == kind)
    return external.split_documents(d)


def words(spark: SparkSession, sf_dir: str) -> dict[str, list[str]]:
    return langid.stopword_lists(table(spark, sf_dir, "stopwords"))


def sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog with the number of lines of each dataset."""
    n = stats.line_counts(table(spark, sf_dir, "bifixer").select("ds")).withColumnRenamed("n", "size")
    d = table(spark, sf_dir, "datasets").select("ds", F.coalesce(T.code_of("src_lang"), F.lit("")).alias("src_lang"), F.coalesce(T.code_of("tgt_lang"), F.lit("")).alias("tgt_lang"), "weight")
    return d.join(n, "ds", "left").na.fill(0, ["size"])


def _judged(spark: SparkSession, sf_dir: str, detected: bool) -> DataFrame:
    p = pairs(spark, sf_dir)
    if not detected:
        return rules.judge(p, S, G, F.col("src_lang"), F.col("tgt_lang"))
    w = words(spark, sf_dir)
    p = langid.detect(langid.detect(p, S, w, "s_ok", "s_lang"), G, w, "t_ok", "t_lang")
    return rules.judge(p, S, G, F.col("src_lang"), F.col("tgt_lang"), rules.Detected("s_ok", "s_lang", "t_ok", "t_lang"))


def rule_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir, False).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def rule_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir, False).select("pair_id", "reason", "keep")


def rule_verdicts_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _judged(spark, sf_dir, True).select("pair_id", "reason", "keep")


def rule_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each rule by itself: how many pairs it alone would reject."""
    p = pairs(spark, sf_dir)
    rs = rules.rules(F.col(S), F.col(G), F.col("src_lang"), F.col("tgt_lang"))
    sums = [F.sum(F.coalesce(c, F.lit(False)).cast("long")).alias(f"r{i}") for i, (_, c) in enumerate(rs)]
    one = p.agg(*sums)
    return one.select(F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.coalesce(f"r{i}", F.lit(0)).alias("n")) for i, (name, _) in enumerate(rs)])).alias("x")).select("x.rule", "x.n")


def with_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs with addresses added to either side, as no segment of the test tables has one: the form goes by pair_id."""
    form, at = F.pmod("pair_id", F.lit(6)), F.concat_ws("/", "ds", "line_no")
    add = lambda x, *forms: F.concat(x, F.element_at(F.array(*forms), (form + 1).cast("int")))
    source = add(F.col(S), F.lit(""), F.concat(F.lit(" https://example.org/"), at), F.concat(F.lit(" www.example.org/"), at, F.lit("_(a(b))")), F.concat(F.lit(" http://a.org/x "), at), F.concat(F.lit(" data.example.net/"), at, F.lit("/(x)(y(z)w).")), F.lit(" ftp:/none"))
    target = add(F.col(G), F.concat(F.lit(" www2.example.com/(b(c)d) "), at), F.lit(""), F.lit(" a.org/"), F.concat(F.lit(" http://a.org/x "), at), F.lit(" https://"), F.lit(" ftp:/none"))
    return pairs(spark, sf_dir).withColumn("__g", target).withColumn(S, source).withColumn(G, F.col("__g")).drop("__g")


def url_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_urls(spark, sf_dir).select("pair_id", rules._urls(F.col(S)).alias("source_chars"), rules._urls(F.col(G)).alias("target_chars"))


def rule_verdicts_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(with_urls(spark, sf_dir), S, G, F.col("src_lang"), F.col("tgt_lang")).select("pair_id", "reason", "keep")


def charfix(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "bifixer")
    return b.select("pair_id", T.charfix(S).alias(S), T.fix_broken_chars(G).alias(G), T.fix_extracted(S).alias("extracted"))


def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = table(spark, sf_dir, "bifixer")
    x = F.col(S)
    return b.select(
        "pair_id", F.char_length(x).alias("chars"), F.octet_length(x).alias("octets"), T.count_of(x, "[  ]").alias("blanks"), T.count_of(x, T.DIGIT).alias("digits"),
        F.round(T.draw("s", "pair_id"), 9).alias("u"), T.language_tag(x, F.lit("de")).alias("tagged"), F.md5(T.charfix(x)).alias("digest"),
    )


def seg_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """XXH64 with seed 0 of source TAB target, and the mean code point."""
    p = pairs(spark, sf_dir)
    return p.select("pair_id", T.xxh64_hex(F.concat_ws("\t", S, G)).alias("seg_hash"), T.mean_code_point(F.concat(S, G)).alias("ranking"))


def rankings(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pairs(spark, sf_dir)
    return p.select("pair_id", T.mean_code_point(F.concat(S, G)).alias("ranking"))


def line_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.line_counts(table(spark, sf_dir, "bifixer").select("ds"))


def size_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.with_total(stats.size_matrix(sized(spark, sf_dir)))


def size_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = sized(spark, sf_dir).filter("tgt_lang IN ('de', 'en', 'fr')")
    return stats.size_table(d, ["de", "en", "fr"])


def language_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.shares(sampling.language_sizes(sized(spark, sf_dir)), "size").select("lang", "size", F.round("share", 9).alias("share"))


def dedup_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.distinct_pairs(table(spark, sf_dir, "bifixer"))


def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pairs(spark, sf_dir).select("pair_id", "ds", "line_no", S, G)
    return dedupe.first_of(p, [S, G], [F.col("pair_id")]).select("pair_id", "ds", "line_no")


def dedup_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.exact_groups(table(spark, sf_dir, "bifixer"), "pair_id")


def dedup_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.near_groups(table(spark, sf_dir, "bifixer"), "pair_id").select("n", "best_id", "ranking")


def _once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (ds, line_no): the first delivery."""
    b = table(spark, sf_dir, "bifixer").select("pair_id", "ds", "line_no", S, G)
    return dedupe.first_of(b, ["ds", "line_no"], [F.col("pair_id")])


def zip_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source lines and the target lines that exist, joined by position; gaps filled up."""
    o = _once(spark, sf_dir)
    a = o.filter(f"{S} IS NOT NULL").select("ds", "line_no", F.col(S).alias("text"))
    b = o.filter(f"{G} IS NOT NULL").select("ds", (F.col("line_no") + 1).alias("line_no"), F.col(G).alias("text"))
    return align.zip_lines(a, b)


def zip_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _once(spark, sf_dir)
    a = o.filter(f"{S} IS NOT NULL").select("ds", "line_no", F.col(S).alias("text"))
    b = o.filter(f"{G} IS NOT NULL").select("ds", (F.col("line_no") + 1).alias("line_no"), F.col(G).alias("text"))
    return align.zip_lines(a, b, pad=False)


def decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Book lines that aren't also lines of another kind of dataset."""
    b = table(spark, sf_dir, "bifixer").select("pair_id", "ds", S, G)
    return align.decontaminate(b.filter("ds LIKE '%Books%'"), b.filter("ds NOT LIKE '%Books%'")).select("pair_id")


def extract_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    ds = table(spark, sf_dir, "datasets").select("ds", "src_lang", "tgt_lang")
    u = table(spark, sf_dir, "tmx_units").join(broadcast_if_small(ds), "ds")
    return readers.extract_units(u, F.col("src_lang"), F.col("tgt_lang")).select("tu_id", S, G)


def extract_units_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units read and units with both sides, per dataset."""
    got = extract_units(spark, sf_dir).select("tu_id", F.lit(1).alias("ok"))
    u = table(spark, sf_dir, "tmx_units").select("tu_id", "ds").join(got, "tu_id", "left")
    return u.groupBy("ds").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("ok").isNull()).alias("skipped"))


def extract_tsv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.extract_tsv(doc_lines(spark, sf_dir, "tsv")).select("doc_id", "line_no", S, G)


def extract_sgm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.extract_sgm(doc_lines(spark, sf_dir, "sgm")).select("doc_id", "line_no", "text")


def extract_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").filter("doc_kind = 'doc_xml' AND text IS NOT NULL")
    return d.select("doc_id", F.posexplode(readers.doc_texts("text")).alias("element", "text"))


def orthography_fix(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = repair.spell_pairs(pairs(spark, sf_dir), table(spark, sf_dir, "orthography"), S, G, F.col("src_lang"), F.col("tgt_lang"))
    return d.select("pair_id", S, G)


def fix_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of the restorative cleaner that are column expressions."""
    x = repair.collapse_blanks(F.col(S))
    x = repair.close_up_punctuation(repair.single_apostrophes(repair.drop_ranges(x, "en")), "en")
    return table(spark, sf_dir, "bifixer").select("pair_id", x.alias("fixed"))


def fix_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of all datasets through all stages, each side by its language, with hash and ranking."""
    return repair.fix_pairs(pairs(spark, sf_dir), S, G, F.col("src_lang"), F.col("tgt_lang"), aggressive=True, orthography=table(spark, sf_dir, "orthography")).select("pair_id", S, G, "seg_hash", "ranking")


def tag_protect(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = pairs(spark, sf_dir)
    return tags.protect_pairs(d, S, G, ["pair_id"]).filter(F.size("repls") > 0).select("pair_id", S, G, tags.to_json_repls("repls").alias("repls"))


def _squeezed(x: Column) -> Column:
    return F.regexp_replace(x, r"[ \t\n\x0b\f\r]+", "")


def tag_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of documents with tags taken out and put back: the line as it was, blanks aside."""
    d = doc_lines(spark, sf_dir).withColumn("x", tags.extract_tags("text"))
    back = tags.reinsert_tags("x.text", "x.repls")
    return d.select("doc_id", "line_no", _squeezed(back).alias("text"))


def tag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = doc_lines(spark, sf_dir).withColumn("f", tags.find_protected("text"))
    return d.select("doc_id", "line_no", F.size("f").alias("n")).filter("n > 0")


def query_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = pairs(spark, sf_dir)
    stop = spans.stopword_map(table(spark, sf_dir, "stopwords"))
    return spans.with_query_span(d, G, F.try_element_at(stop, F.col("tgt_lang")), ["pair_id"]).select("pair_id", "query")


def paste_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each source with its target's query span behind it."""
    stop = spans.stopword_map(table(spark, sf_dir, "stopwords"))
    d = spans.with_query_span(pairs(spark, sf_dir), G, F.try_element_at(stop, F.col("tgt_lang")), ["pair_id"])
    return d.select("pair_id", spans.paste_query(F.col(S), F.col("query")).alias("text"))


def langid_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "bifixer").withColumn("s", langid.scores(S, words(spark, sf_dir)))
    return d.select("pair_id", F.posexplode(langid.top_labels(F.col("s"))).alias("rank", "lang"))


def langid_reliable(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = langid.detect(table(spark, sf_dir, "bifixer"), S, words(spark, sf_dir))
    return d.groupBy("detected", "reliable").agg(F.count(F.lit(1)).alias("n"))


def langcheck(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = langid.check_languages(pairs(spark, sf_dir), S, G, F.col("src_lang"), F.col("tgt_lang"), words(spark, sf_dir))
    return d.select("pair_id", "lang_ok")


def _probabilities(method: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return sampling.distribution(sized(spark, sf_dir), method, 5.0).select("ds", F.round("prob", 9).alias("prob"))

    return q


def resample_parallel(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _once(spark, sf_dir)
    ds = sized(spark, sf_dir).drop("size")
    return sampling.resample_parallel(b, ds, 5000, "uniform", seed="r6").select("draw_no", "ds", "line_no")


def resample_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _once(spark, sf_dir)
    return sampling.resample_parallel(b, sized(spark, sf_dir).drop("size"), 5000, "temperature", 5.0, True, "r6").groupBy("ds").agg(F.count(F.lit(1)).alias("n"))


def _resample_mono(method: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        b = _once(spark, sf_dir).select("ds", "line_no", F.coalesce(S, F.lit("")).alias("text"))
        ds = sized(spark, sf_dir).select("ds", F.col("src_lang").alias("lang")).filter("lang <> ''")
        return sampling.resample_mono(b, ds, 5000, method, dataset_method=method, seed="r7").select("draw_no", "lang", "ds", "line_no")

    return q


def shard_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = shards.assign_shards(_once(spark, sf_dir).select("ds", "line_no"), 1, 10)
    return d.select("ds", "line_no", "shard", "n_shards")


def shard_replicate(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = shards.replicate(shards.assign_shards(_once(spark, sf_dir).select("ds", "line_no"), 1, 4), 4)
    return d.groupBy("ds", "shard").agg(F.count(F.lit(1)).alias("n"), F.min("line_no").alias("first_line"))


def line_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _once(spark, sf_dir).select("ds", "line_no", F.coalesce(S, F.lit("")).alias("text"))
    return stats.line_offsets(d, chunk=50)


def multimeta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which languages have each line of a set of files, one per language: the documents of a language as its lines."""
    d = stats.row_numbers(table(spark, sf_dir, "documents").filter("lang IS NOT NULL").select("lang", "text", "doc_id"), "lang", "doc_id", "line_no")
    return stats.lines_by_language(d.withColumn("text", F.coalesce("text", F.lit("")))).select("line_no", F.array_join("langs", ",").alias("langs"))


def catalog_discovery(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "datasets")
    files = d.select(F.explode(F.array("src", "tgt")).alias("path")).filter("path <> ''")
    return catalog.discover(files, ["da", "de", "en", "es", "fr", "nl", "pt", "ru", "sv"], root="data/", exclude=["Crawl"], mono=True)


def stopword_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "stopwords").filter("word <> ''")
    return d.groupBy("lang").agg(F.array_join(F.array_sort(F.collect_set("word")), " ").alias("words"))


def pipe_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return external.pipe_documents(d, "cat").select("doc_id", F.md5("text").alias("digest"))


def clean_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """charfix, rules and deduplication in one plan."""
    return run(pairs(spark, sf_dir), ["charfix", "biclean", "dedup"], Commands()).select("ds", "line_no")


def clean_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All seven commands in one plan."""
    c = Commands(words(spark, sf_dir), orthography=table(spark, sf_dir, "orthography"))
    d = run(pairs(spark, sf_dir), ["charfix", c.bifix(F.col("src_lang"), F.col("tgt_lang")), "biclean", "dedup", "langcheck", "tagprotect", "queries"], c)
    return d.select("ds", "line_no", S, G, "seg_hash", tags.to_json_repls("repls").alias("repls"), "query")


def clean_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """charfix, rules, deduplication and language check in one plan."""
    return run(pairs(spark, sf_dir), ["charfix", "biclean", "dedup", "langcheck"], Commands(words(spark, sf_dir))).select("ds", "line_no")


def extract_sgms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of the English SGM documents zipped with those of the German ones, each in order of documents and lines."""
    d = doc_lines(spark, sf_dir, "sgm").withColumn("line_no", F.col("doc_id") * 1_000_000 + F.col("line_no"))
    side = lambda x: d.filter(F.col("lang") == x).select("line_no", "text")
    return readers.extract_sgms(side("en"), side("de"))


def multiway_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metadata of all pairs as a set of two files."""
    d = table(spark, sf_dir, "bifixer").select(F.lit("x").alias("one"), "pair_id", F.explode(F.array(F.struct(F.lit("src").alias("lang"), F.col(S).alias("text")), F.struct(F.lit("tgt").alias("lang"), F.col(G).alias("text")))).alias("x"))
    lines = stats.row_numbers(d.select("x.lang", "pair_id", F.coalesce("x.text", F.lit("")).alias("text")), "lang", "pair_id", "line_no").drop("pair_id")
    return stats.multiway_meta(lines, {"src": "all.src", "tgt": "all.tgt"})


# -- what is written is read again ---------------------------------------------------------------------------------------
def _one_line(x: str) -> Column:
    return F.translate(F.coalesce(x, F.lit("")), "\n\r", "  ")


def roundtrip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources as line files and read again: each file's lines by their number, put in order of files."""
    path = fresh_path(spark, "lines")
    writers.write_lines(table(spark, sf_dir, "bifixer").select("pair_id", _one_line(S).alias("text")), path, "text", ["pair_id"])
    d = readers.read_lines(spark, path)
    sizes = d.groupBy("file").agg(F.max("line_no").alias("n"))
    sizes = sizes.select("file", (F.sum("n").over(Window.partitionBy().orderBy("file")) - F.col("n")).alias("before"))
    return d.join(sizes, "file").select((F.col("before") + F.col("line_no")).alias("line_no"), "text")


def roundtrip_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "json")
    d = table(spark, sf_dir, "bifixer").select("pair_id", "ds", S, G)
    writers.write_json_lines(d, path)
    return spark.read.schema(d.schema).json(path)


def roundtrip_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "shards")
    writers.write_shards(shards.assign_shards(_once(spark, sf_dir).select("ds", "line_no"), 1, 10), path)
    return spark.read.parquet(path).select("ds", "line_no", F.col("shard").cast("int").alias("shard"))


def roundtrip_by_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "by")
    writers.write_by(table(spark, sf_dir, "bifixer").select("pair_id", "ds", S), path, "ds")
    return spark.read.parquet(path).select("pair_id", "ds", S)


def roundtrip_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units written as TMX and extracted for English and German."""
    path = fresh_path(spark, "tmx")
    u = table(spark, sf_dir, "tmx_units").filter(F.size("tuv") > 0)
    clean = F.transform("tuv", lambda v: F.struct(v["lang"].alias("lang"), F.trim(F.regexp_replace(v["seg"], r"\s+", " ")).alias("seg")))
    writers.write_units(u.select(clean.alias("tuv")), path)
    return readers.extract_tmx(spark, path, "en", "de").groupBy("source_segment", "target_segment").agg(F.count(F.lit(1)).alias("n"))


def roundtrip_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The size table as CSV."""
    path = fresh_path(spark, "csv")
    writers.write_matrix(size_pivot(spark, sf_dir), path)
    return spark.read.option("header", "true").schema("src_lang STRING, de DOUBLE, en DOUBLE, fr DOUBLE").csv(path).na.fill("", ["src_lang"])


def roundtrip_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as document XML, without the characters XML can't hold, blanks at the ends aside."""
    path = fresh_path(spark, "xml")
    d = table(spark, sf_dir, "documents").filter("text IS NOT NULL")
    plain = F.regexp_replace("text", r"[^\x20-\x{d7ff}]+", " ")
    writers.write_doc_xml(d.select(F.col("doc_id").cast("string").alias("_id"), plain.alias("text")), path)
    got = readers.read_doc_xml(spark, path)
    return got.select(F.col("_id").cast("long").alias("doc_id"), F.md5(F.trim(F.coalesce(F.regexp_replace("text", r"\s+", " "), F.lit("")))).alias("digest"))


def hourly_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.date_trunc("hour", "ts").alias("hour"), "event_type").agg(F.count(F.lit(1)).alias("n"))


def queries() -> dict[str, Query]:
    named = [
        rule_report, rule_verdicts, rule_verdicts_lang, rule_flags, url_lengths, rule_verdicts_urls, charfix, scalar_functions, seg_hashes, rankings, line_counts, size_matrix, size_pivot, language_sizes,
        dedup_exact, dedup_first, dedup_groups, dedup_near, zip_pad, zip_left, decontaminate, extract_units, extract_units_report, extract_tsv, extract_sgm, extract_docs,
        orthography_fix, fix_native, fix_full, tag_protect, tag_roundtrip, tag_counts, query_spans, paste_queries, langid_topk, langid_reliable, langcheck,
        resample_parallel, resample_counts, shard_assign, shard_replicate, line_offsets, multimeta, catalog_discovery, stopword_table, pipe_docs, clean_pipeline, hourly_events,
        clean_chain, clean_checked, extract_sgms, multiway_meta, roundtrip_lines, roundtrip_json, roundtrip_shards, roundtrip_by_dataset, roundtrip_units, roundtrip_matrix, roundtrip_docs,
    ]
    return {f.__name__: f for f in named} | {f"sample_{m}": _probabilities(m) for m in sampling.METHODS} | {f"resample_mono_{m}": _resample_mono(m) for m in ("original", "uniform", "temperature")}


def oracle_sql() -> dict[str, str]:
    return oracle.sql()
