"""The registered queries of the operators: each over the whole table it is meant for."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowloom.llm import bit_planes, grammar_runs, kneser_ney, ordinal_quality, rank_fim, spot_signatures, toxic_cnn
from rowloom.llm.minimax_shards import minimax_shards
from rowloom.llm.pigeon_simhash import near_duplicates
from rowloom.llm.poisson_mix import poisson_mix
from rowloom.llm.revisits import header_text, resolve_revisits
from rowloom.llm.site_style import main_texts
from rowloom.llm.spaced_seeds import contaminated

SHARDS = 8
MIX_POWER, MIX_SEED = 0.5, "mix"
TOXIC_SCORE = 0.3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_site_style(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return main_texts(table(spark, sf_dir, "pages"))


def op2_toxic_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, from labels outside the held-out quarter."""
    docs = table(spark, sf_dir, "documents")
    out = toxic_cnn.scored(docs, toxic_cnn.train(docs, table(spark, sf_dir, "labels")))
    predicted = (F.col("score") >= TOXIC_SCORE).cast("int").alias("predicted")
    return out.select("doc_id", "held_out", "score", predicted, "threshold", "flagged")


def op3_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the stretch that it holds."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade, tail probability and acceptance of every document."""
    docs = table(spark, sf_dir, "documents")
    rated = ordinal_quality.ratings(table(spark, sf_dir, "labels"))
    return ordinal_quality.graded(docs, ordinal_quality.train(docs, rated))


def op5_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint of every document and of its edited text, and how alike they and the next document are."""
    return spot_signatures.fingerprints(table(spark, sf_dir, "documents"))


def op6_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents replicated to damped source shares, in random order."""
    return poisson_mix(table(spark, sf_dir, "documents"), power=MIX_POWER, seed=MIX_SEED)


def op7_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the ids of every document stand, read back from the files they were written to."""
    import public_tokenizers

    return bit_planes.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def archive_records(pages: DataFrame) -> DataFrame:
    """Every page as a full response of its section's front, and one later visit there, answered with "not modified".

    Fronts are captured again and again, so a visit may find another response than its own page. The visits carry, in
    turn, the weak tag, the time of last modification, another tag and the same tag.
    """
    own = pages.filter("page_id IS NOT NULL").select(
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace("url", "/[0-9]+", "/").alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
    )
    turn, at, page = F.col("page_id") % 4, F.col("page_id") * 10, F.md5("html")
    tag = F.concat(F.lit('"'), page, F.lit('"'))
    text = lambda c: c.cast("string")
    response = own.select(
        (F.col("page_id") * 2).alias("record_id"),
        "url",
        at.alias("captured"),
        F.lit("response").alias("kind"),
        F.lit(200).alias("status"),
        tag.alias("etag"),
        text(at).alias("last_modified"),
        F.map_from_arrays(
            F.array(*map(F.lit, ("Content-Type", "Content-Length", "Date", "ETag", "Last-Modified"))),
            F.array(F.lit("text/html"), text(F.length("html")), text(at), tag, text(at)),
        ).alias("headers"),
        page.alias("payload_md5"),
    )
    later = at + 5 + F.when(F.col("page_id") % 3 == 0, 10 * (F.col("page_id") % 97)).otherwise(0)
    new_tag = F.when(turn == 0, F.concat(F.lit("W/"), tag)).when(turn == 2, F.lit('"changed"')).when(turn == 3, tag)
    revisit = own.select(
        (F.col("page_id") * 2 + 1).alias("record_id"),
        "url",
        later.alias("captured"),
        F.lit("revisit").alias("kind"),
        F.lit(304).alias("status"),
        new_tag.alias("etag"),
        F.when(turn == 1, text(at)).alias("last_modified"),
        F.map_from_arrays(
            F.array(*map(F.lit, ("date", "cache-control", "content-length", "set-cookie"))),
            F.array(text(later), F.lit("max-age=60"), F.lit("0"), F.lit("a=b")),
        ).alias("headers"),
        F.lit(None).cast("string").alias("payload_md5"),
    )
    return response.unionByName(revisit)


def op8_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each later visit of a page's address stands for."""
    found = resolve_revisits(archive_records(table(spark, sf_dir, "pages")), carried=("payload_md5",))
    return found.withColumn("headers", header_text(F.col("headers")))


def op9_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards of nearly equal bytes, equal texts together."""
    out = minimax_shards(table(spark, sf_dir, "documents"), SHARDS)
    grown = F.lit(None).cast("int").alias("grown_shard")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", grown)


def op10_pigeon_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint and the class of near-duplicates of every document."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How likely every document is by an n-gram model of those that are not held out."""
    docs = table(spark, sf_dir, "documents")
    return kneser_ney.scored(docs, kneser_ney.train(docs))


def planted(doc_id: int | None, n: int) -> np.ndarray | None:
    """Where the n words of a document are taken from: one document in ten repeats a stretch of its own to the end."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return None
    g, at = h // 10, np.arange(n)
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    return np.where(at < a, at, a + (at - a) % period)


def op12_grammar_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of repeated words of every document, some of which repeat a stretch of theirs."""
    return grammar_runs.digests(table(spark, sf_dir, "documents"), edit=planted)


def op13_rank_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fill-in-the-middle form of every document, cut through its rank index, and the text rebuilt from it."""
    return rank_fim.digests(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_site_style,
        op2_toxic_cnn,
        op3_spaced_seeds,
        op4_ordinal_quality,
        op5_spot_signatures,
        op6_poisson_mix,
        op7_bit_planes,
        op8_revisits,
        op9_minimax_shards,
        op10_pigeon_simhash,
        op11_kneser_ney,
        op12_grammar_runs,
        op13_rank_fim,
    )
}

SQL: dict[str, str] = {
    "op13_rank_fim": """
        WITH own AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
        drawn AS (
            SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
                CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM own),
        cuts AS (
            SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
                CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                    WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
        parts AS (
            SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM cuts)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
            CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
            sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
            sha256(CASE form WHEN 'plain' THEN t ELSE prefix || middle || suffix END) AS restored_sha256
        FROM parts""",
    "op8_revisits": r"""
        WITH bare AS (
            SELECT page_id, md5(coalesce(html, '')) AS page, length(coalesce(html, '')) AS n,
                regexp_replace(trim(regexp_replace(url, '/[0-9]+', '/', 'g')), '#.*$', '') AS url
            FROM pages WHERE page_id IS NOT NULL),
        parts AS (
            SELECT page_id, page, n,
                regexp_replace(regexp_replace(lower(regexp_extract(
                    url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?@]*@)?([^/?]*)', 2)), ':(80|443)$', ''), '^www[0-9]*\.', '') AS host,
                regexp_replace(regexp_replace(regexp_replace(
                    url, '^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?@]*@)?[^/?]*', ''), '[?].*$', ''), '/+$', '') AS path,
                array_to_string(list_sort(list_filter(string_split(regexp_extract(url, '[?](.*)$', 1), '&'), lambda p:
                    p <> '' AND NOT regexp_matches(lower(p), '^(utm_[a-z]*|ref|fbclid|gclid|sessionid)(=|$)'))), '&') AS query
            FROM bare),
        own AS (
            SELECT page_id, page, n, page_id * 10 AS taken, page_id * 10 + 5 + CASE WHEN page_id % 3 = 0 THEN 10 * (page_id % 97) ELSE 0 END AS later,
                host || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN query = '' THEN '' ELSE '?' || query END
                    AS canonical_url
            FROM parts),
        visits AS (
            SELECT v.*, r.page_id AS old_id, r.page AS old_page, r.n AS old_n, r.taken AS old_taken
            FROM own v ASOF LEFT JOIN own r ON v.canonical_url = r.canonical_url AND v.later > r.taken),
        judged AS (
            SELECT *, CASE
                WHEN old_id IS NULL THEN 'no_earlier_response'
                WHEN page_id % 4 = 1 THEN CASE WHEN taken = old_taken THEN 'resolved' ELSE 'validator_mismatch' END
                WHEN page_id % 4 = 2 THEN 'validator_mismatch'
                WHEN page = old_page THEN 'resolved' ELSE 'validator_mismatch' END AS outcome
            FROM visits)
        SELECT page_id * 2 + 1 AS record_id, canonical_url, later AS captured, outcome,
            CASE WHEN outcome = 'resolved' THEN old_id * 2 END AS refers_to,
            CASE WHEN outcome = 'resolved' THEN 'cache-control: max-age=60' || chr(10) || 'content-length: ' || old_n || chr(10)
                || 'content-type: text/html' || chr(10) || 'date: ' || later || chr(10) || 'etag: "' || old_page || '"' || chr(10)
                || 'last-modified: ' || old_taken END AS headers,
            CASE WHEN outcome = 'resolved' THEN old_page END AS payload_md5
        FROM judged""",
    "op6_poisson_mix": f"""
        WITH sizes AS (SELECT source, count(*) AS n, pow(count(*)::DOUBLE, {MIX_POWER}) AS weight FROM documents GROUP BY 1),
        rates AS (SELECT source, weight * (SELECT sum(n) FROM sizes) / (SELECT sum(weight) FROM sizes) / n AS rate FROM sizes),
        terms AS (
            SELECT source, rate, u.k, CASE WHEN u.k = 0 THEN 0.0 ELSE ln(rate / u.k) END AS step
            FROM rates, LATERAL unnest(range(0, CAST(ceil(rate + 12 * sqrt(rate) + 40) AS BIGINT) + 1)) AS u(k)),
        logs AS (SELECT source, k, sum(step) OVER (PARTITION BY source ORDER BY k) - rate AS log_term FROM terms),
        below AS (SELECT source, k, sum(exp(log_term)) OVER (PARTITION BY source ORDER BY k) AS below FROM logs),
        draws AS (
            SELECT *, CAST('0x' || substr(md5('{MIX_SEED}:' || doc_id), 1, 13) AS BIGINT) / pow(2, 52) AS draw FROM documents),
        counts AS (
            SELECT d.doc_id, count(b.k) AS copies
            FROM draws d JOIN below b ON b.source = d.source AND b.below <= d.draw GROUP BY 1)
        SELECT d.*, u.copy, md5('{MIX_SEED}:' || doc_id || ':' || u.copy) AS shuffle_key
        FROM documents d JOIN counts c USING (doc_id), LATERAL unnest(range(1, c.copies + 1)) AS u(copy)""",
}
