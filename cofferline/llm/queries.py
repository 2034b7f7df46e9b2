"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cofferline.llm import (
    bpe,
    collocations,
    decontaminate,
    html_text,
    jaccard,
    neighbours,
    periodic_runs,
    pii,
    source_mix,
    token_counts,
    token_files,
    toxicity,
    url_filter,
)
from cofferline.llm.common import staging_folder, table


def op1_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return jaccard.jaccard_components(docs, shingle=4, percent=85)


def op1_ngram_links(spark: SparkSession, folder: str) -> DataFrame:
    """The join of op1_ngram_jaccard with the number of links of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return jaccard.jaccard_components(docs, shingle=4, percent=85, counted=True)


def op2_main_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", "html")
    found = html_text.extract_main_text(pages)
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


SITE_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op3_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rows = [url_filter.site_rule(*rule) for rule in SITE_RULES]
    rows += [url_filter.host_word_rule("block", word) for word in url_filter.UNWANTED_HOST_WORDS]
    pages = table(spark, folder, "pages").select("page_id", "url")
    judged = url_filter.judge_urls(pages, url_filter.rule_table(spark, rows))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find_benchmark(docs, table(spark, folder, "benchmark")).select("doc_id", "found")
    names = F.array_join(F.array_sort(F.col("found.items").cast("array<string>")), ",")
    return found.select(
        "doc_id",
        "found.n_words",
        "found.n_hit",
        F.size("found.items").cast("long").alias("n_items"),
        F.sha2(names.cast("binary"), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, folder, "documents").select("doc_id", "text")
    encoded = bpe.byte_bpe_encode(docs, ranks, public_tokenizers.PATTERN)
    decoded = bpe.byte_bpe_decode(encoded, ranks)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    files = token_files.write_token_files(
        docs, staging_folder(spark, "tokens"), public_tokenizers.path("word_bpe_49k.json")
    )
    return token_files.read_token_files(files).select(
        "doc_id", "start", "n_tokens", F.crc32("tokens").alias("ids_crc32")
    )


def toxicity_model(spark: SparkSession, folder: str) -> dict:
    """Fitted on labels outside the held-out fifth."""
    labels = table(spark, folder, "labels").select("doc_id", F.col("toxic").alias("label"))
    return toxicity.fit(table(spark, folder, "documents"), labels.filter(~held_out()))


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity.score_toxicity(docs, toxicity_model(spark, folder))
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("toxicity.score").alias("score"),
        (F.col("toxicity.score") >= 0.5).cast("int").alias("predicted"),
    )


def _span_text(spans):
    """kind:start:end of spans that are in order already."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = pii.find_pii(docs, pii.fit(docs))
    base = F.filter("spans", lambda s: s.base)
    kinds = F.transform(base, lambda s: s.kind)
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_span_text(base).cast("binary"), 256).alias("base_sha256"),
        _span_text(F.col("spans")).alias("spans"),
    )


def op9_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return neighbours.nearest(vectors.filter("vec_id % 20 = 0"), vectors, k=20)


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counts before and after personal data is masked by edits."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = pii.find_pii(docs, None)
    mask = F.transform("spans", lambda s: F.struct(s.start.alias("start"), s.end.alias("end"), F.concat(F.lit("["), s.kind, F.lit("]")).alias("text")))
    counted = token_counts.count_tokens(
        found.withColumn("edits", mask), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )
    return counted.select(
        "doc_id",
        F.col("counted.before").alias("n_tokens"),
        F.col("counted.edits").alias("n_edits"),
        F.col("counted.after").alias("n_tokens_edited"),
        F.col("counted.recounted").alias("n_recounted"),
        F.sha2(F.coalesce(F.col("counted.text"), F.col("text")).cast("binary"), 256).alias("edited_sha256"),
    )


def op11_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents").select("lang", "text"), least=100, top=2000)


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of every document; a tenth of the documents is given repeats first."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    words, hashed = periodic_runs.words_of(F.col("text")), F.crc32(F.col("doc_id").cast("string").cast("binary"))
    n, g = F.size(words), F.floor(hashed / 10)
    first = g % n
    period = 1 + F.floor((n - first) / (3 + g % 8))
    chosen = F.coalesce(hashed % 10 == 0, F.lit(False)) & (n > 0)
    text = F.when(chosen, periodic_runs.with_repeats(F.col("text"), words, first, period)).otherwise(F.col("text"))
    found = periodic_runs.find_runs(docs.select("doc_id", text.alias("text"))).select("doc_id", "found.*")
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start.cast("string"), r.length.cast("string"), r.period.cast("string")), F.lit("\n")))
    length, period = longest["length"], -longest["period"]
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-longest["start"]).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    mixed = source_mix.mix(table(spark, folder, "documents").select("doc_id", "source", "text"), weights=(1.0, 2.0, 3.0), most=3)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


QUERIES = {
    "op1_ngram_jaccard": op1_ngram_jaccard,
    "op1_ngram_links": op1_ngram_links,
    "op2_main_text": op2_main_text,
    "op3_url_filter": op3_url_filter,
    "op4_decontaminate": op4_decontaminate,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_token_files": op6_token_files,
    "op7_toxicity": op7_toxicity,
    "op8_pii": op8_pii,
    "op9_neighbours": op9_neighbours,
    "op10_token_counts": op10_token_counts,
    "op11_collocations": op11_collocations,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_source_mix": op13_source_mix,
}

_HOSTS = """
    SELECT page_id,
           translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
    FROM pages
"""

_SITES = " UNION ALL ".join(
    f"SELECT '{rule}' AS rule, '{verdict}' AS verdict, '{rule.partition('/')[0]}' AS h, '/{rule.partition('/')[2]}' AS p"
    for verdict, rule in SITE_RULES
)

_UNWANTED = "|".join(url_filter.UNWANTED_HOST_WORDS)

_WORDS = r"""
    regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
"""

ORACLE: dict[str, str] = {
    "op1_ngram_jaccard": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w FROM documents),
        g AS (
            SELECT DISTINCT doc_id, w[i : i + 3] AS gram
            FROM d, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS t(i) WHERE len(w) > 0),
        n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
        links AS (
            SELECT a, b FROM (
                SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
                FROM g x JOIN g y ON x.gram = y.gram AND x.doc_id <> y.doc_id GROUP BY ALL)
            JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
            WHERE 100 * common >= 85 * (na.n + nb.n - common)),
        reach AS (
            SELECT doc_id AS a, doc_id AS b FROM d
            UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
        SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reach.b) AS component_id
        FROM d LEFT JOIN n ON n.doc_id = d.doc_id JOIN reach ON reach.a = d.doc_id GROUP BY d.doc_id
    """,
    "op3_url_filter": f"""
        WITH u AS ({_HOSTS}), sites AS ({_SITES}), best AS (
            SELECT host, path, arg_max(struct_pack(rule := rule, verdict := verdict), length(h) + length(p)) AS best
            FROM (SELECT DISTINCT host, path FROM u) JOIN sites
              ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
            GROUP BY host, path)
        SELECT page_id, host, path, best.rule AS rule,
               coalesce(best.verdict, CASE WHEN regexp_matches(host, '(^|[.-])({_UNWANTED})([.-]|$)')
                                           THEN 'block' ELSE 'allow' END) AS verdict
        FROM u LEFT JOIN best USING (host, path)
    """,
    "op4_decontaminate": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
        phrases AS (
            SELECT DISTINCT item_id, w[i : i + 12] AS phrase, len(w[i : i + 12]) AS n
            FROM b, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS t(i) WHERE len(w) > 0),
        lengths AS (SELECT DISTINCT n FROM phrases),
        windows AS (
            SELECT doc_id, i, n, w[i : i + n - 1] AS phrase
            FROM d, lengths, unnest(range(1, len(w) - n + 2)) AS t(i)),
        found AS (
            SELECT doc_id, i, n, item_id FROM windows JOIN phrases USING (n, phrase)),
        hits AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM found, unnest(range(i, i + n)) AS t(p) GROUP BY doc_id),
        items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
            FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(names, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
    "op9_neighbours": """
        WITH v AS (
            SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, max(list_dot_product(q.e, c.e)) AS score
            FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
            GROUP BY ALL)
        SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
        FROM scored QUALIFY rank <= 20
    """,
}

ORACLE["op1_ngram_links"] = ORACLE["op1_ngram_jaccard"].replace(
    "min(reach.b) AS component_id",
    "min(reach.b) AS component_id, (SELECT count(*) FROM links WHERE links.a = d.doc_id) AS n_links",
)
