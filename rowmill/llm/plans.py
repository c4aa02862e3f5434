"""The registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rowmill.llm.common import table, written
from rowmill.llm.conversation_repair import damaged, repaired_conversations
from rowmill.llm.decontaminate import overlaps
from rowmill.llm.html_text import extracted
from rowmill.llm.importance import resample
from rowmill.llm.licences import licences_in
from rowmill.llm.line_dedup import drop_shared_lines
from rowmill.llm.mixing import mix, token_estimate
from rowmill.llm.prefix_trie import ended_at, prefix_trie, rebuilt
from rowmill.llm.secrets import candidates, judge, labelled_by_rules
from rowmill.llm.sharding import row_bytes, shard_by_bytes
from rowmill.llm.simhash import near_duplicates
from rowmill.llm.topk import top_k, whole_weights
from rowmill.llm.url_reputation import judge_urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


#: Rules of the URL query: verdict, host, path.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
#: Least posterior bound of an allowed host, and how many standard deviations it lies below the mean.
LEAST_REPUTATION, REPUTATION_Z = 0.75, 1.645

_RULE_SQL = " ".join(
    f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{v} {h}{p}'"
    for v, h, p in sorted(URL_RULES, key=lambda r: -len(r[1] + r[2]))
)


@query(
    f"""
    WITH parts AS (
      SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
    hosts AS (
      SELECT host, count(quality) AS n, coalesce(sum(CASE WHEN quality = 1 THEN 1 ELSE 0 END), 0) AS k
      FROM parts LEFT JOIN labels ON page_id = doc_id GROUP BY host),
    named AS (SELECT *, array_to_string(string_split(host, '.')[-2:], '.') AS domain,
      string_split(host, '.')[-1] AS suffix FROM hosts),
    total AS (SELECT (sum(k) + 1.0) / (sum(n) + 2.0) AS share FROM named),
    suffixes AS (SELECT suffix, (sum(k) + 2.0 * any_value(share)) / (sum(n) + 2.0) AS mean
      FROM named, total GROUP BY suffix),
    domains AS (SELECT suffix, domain, sum(n) AS n, sum(k) AS k FROM named GROUP BY suffix, domain),
    spread1 AS (SELECT sum(CASE WHEN n > 0 THEN n * (k / n - mean) ^ 2 END) AS seen,
      sum(CASE WHEN n > 0 THEN mean * (1 - mean) END) AS chance,
      sum(CASE WHEN n > 0 THEN mean * (1 - mean) * (n - 1) END) AS spare FROM domains JOIN suffixes USING (suffix)),
    weight1 AS (SELECT CASE WHEN coalesce(spare, 0) = 0 OR seen <= chance THEN 1000.0
      ELSE least(1000.0, greatest(1.0, spare / (seen - chance) - 1)) END AS w FROM spread1),
    domain_means AS (SELECT domain, (k + w * mean) / (n + w) AS above FROM domains JOIN suffixes USING (suffix), weight1),
    spread2 AS (SELECT sum(CASE WHEN n > 0 THEN n * (k / n - above) ^ 2 END) AS seen,
      sum(CASE WHEN n > 0 THEN above * (1 - above) END) AS chance,
      sum(CASE WHEN n > 0 THEN above * (1 - above) * (n - 1) END) AS spare FROM named JOIN domain_means USING (domain)),
    weight2 AS (SELECT CASE WHEN coalesce(spare, 0) = 0 OR seen <= chance THEN 1000.0
      ELSE least(1000.0, greatest(1.0, spare / (seen - chance) - 1)) END AS w FROM spread2),
    host_means AS (SELECT host, n, w, (k + w * above) / (n + w) AS mean
      FROM named JOIN domain_means USING (domain), weight2),
    bounds AS (SELECT host, mean - {REPUTATION_Z} * sqrt(mean * (1 - mean) / (n + w + 1)) AS bound FROM host_means),
    ruled AS (SELECT *, CASE {_RULE_SQL} END AS found FROM parts JOIN bounds USING (host))
    SELECT page_id, host, path, string_split(found, ' ')[2] AS rule,
      coalesce(string_split(found, ' ')[1], CASE WHEN bound >= {LEAST_REPUTATION} THEN 'allow' ELSE 'block' END)
        AS verdict, round(bound, 6) AS bound
    FROM ruled"""
)
def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("id"), (F.col("quality") == 1).alias("good"))
    pages = table(spark, folder, "pages")
    return judge_urls(pages, labels, URL_RULES, least=LEAST_REPUTATION, z=REPUTATION_Z)


@query()
def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), words=3, threshold=3)


SHARDS = 40


@query(
    f"""
    WITH sized AS (SELECT doc_id, coalesce(strlen(text), 0) + 16 AS size, encode(text) AS bytes FROM documents),
    table_of AS (SELECT list(c ORDER BY i) AS crcs FROM (
      SELECT i, list_reduce(list_prepend(i, range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
      FROM (SELECT unnest(range(256)) AS i))),
    summed AS (SELECT doc_id, size, CASE WHEN bytes IS NOT NULL THEN xor(4294967295, list_reduce(
        list_prepend(4294967295, list_transform(range(octet_length(bytes)),
          lambda i: ('0x' || hex(bytes[i + 1:i + 1]))::BIGINT)),
        lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1]))) END AS text_crc32 FROM sized, table_of),
    placed AS (SELECT *, row_number() OVER o AS place, sum(size) OVER o AS upto, sum(size) OVER () AS total
      FROM summed WINDOW o AS (ORDER BY doc_id, text_crc32, size ROWS UNBOUNDED PRECEDING)),
    cut AS (SELECT *, least({SHARDS} - 1, ((2 * upto - size) * {SHARDS}) // (2 * total))::INT AS shard FROM placed)
    SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard,
      row_number() OVER (PARTITION BY shard ORDER BY place) - 1 AS slot, NULL::INT AS grown_shard
    FROM cut"""
)
def op5_sharding(spark: SparkSession, folder: str) -> DataFrame:
    digests = table(spark, folder, "documents").select(
        "doc_id", row_bytes(F.col("text")).alias("size"), F.crc32("text").alias("text_crc32")
    )
    order = [F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    return shard_by_bytes(digests, SHARDS, F.col("size"), order).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query(
    """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS w FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (SELECT q.vec_id AS query_id, v.vec_id,
      list_sum(list_transform(list_zip(q.w, v.w), lambda p: p[1] * p[2]))::BIGINT AS score
      FROM v q JOIN v ON q.vec_id % 20 = 0 AND v.vec_id <> q.vec_id)
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score
    FROM scored QUALIFY rank <= 20"""
)
def op6_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", whole_weights("embedding").alias("weights"))
    return top_k(vectors, vectors.where("vec_id % 20 = 0"), 20, "vec_id", "weights")


#: Target shares: domains, languages in them, sources (equal where none is named).
MIX_WEIGHTS = {
    ("web",): 5,
    ("books",): 3,
    ("papers",): 2,
    **{(d, lang): w for d in ("web", "books", "papers") for lang, w in (("en", 6), ("de", 2), ("fr", 2), ("es", 1))},
    ("web", "en", "src0"): 3,
}
MIX_SEED = 20
#: Tokens to give, as a share of all tokens, and how often a document may be given at most.
MIX_SHARE, MIX_EPOCHS = 0.75, 2


def mix_levels(document: str = "") -> dict:
    """Domain, language and source of a document (with a prefix: a struct); the domain follows the source's number."""
    source = F.col(f"{document}source")
    number = F.substr(source, F.lit(4)).try_cast("int")
    domain = F.when(number < 10, "web").when(number < 15, "books").when(number >= 15, "papers").otherwise("other")
    return {"domain": domain, "language": F.col(f"{document}lang"), "origin": source}


def mix_oracle(share: float, epochs: int) -> str:
    """The mixing of ``documents`` in SQL."""
    levels = ["domain", "lang", "source"]

    def weight(depth: int) -> str:
        named = " ".join(
            f"WHEN {' AND '.join(f"{c} = '{v}'" for c, v in zip(levels, path))} THEN {float(w)}"
            for path, w in MIX_WEIGHTS.items()
            if len(path) == depth
        )
        return f"CASE {named} ELSE 1.0 END"

    steps, above = [], None
    for depth in (1, 2, 3):
        own, parents = levels[:depth], levels[: depth - 1]
        part = f"PARTITION BY {', '.join(parents)}" if parents else ""
        source = f"n{depth - 1} JOIN l USING ({', '.join(parents)})" if parents else "l, budget"
        order = f"ORDER BY cap / weight, {', '.join(own)}"
        steps.append(
            f"""c{depth} AS (SELECT {', '.join(own)}, sum(l.supply) * {epochs}.0 AS cap, any_value({'given' if parents else 'tokens'})::DOUBLE
                AS to_share, {weight(depth)} AS weight FROM {source} GROUP BY {', '.join(own)}),
            f{depth} AS (SELECT *, (to_share - coalesce(sum(cap) OVER ({part} {order} ROWS BETWEEN UNBOUNDED PRECEDING
                AND 1 PRECEDING), 0)) / sum(weight) OVER ({part} {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED
                FOLLOWING) AS level, row_number() OVER ({part} {order}) AS k FROM c{depth}),
            n{depth} AS (SELECT {', '.join(own)}, CASE WHEN cap <= weight * level THEN cap ELSE weight *
                first_value(CASE WHEN cap > weight * level THEN level END IGNORE NULLS)
                OVER ({part} ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) END AS given FROM f{depth})"""
        )
    return f"""
    WITH d AS (SELECT doc_id, lang, source, CASE WHEN num < 10 THEN 'web' WHEN num < 15 THEN 'books' WHEN num >= 15
        THEN 'papers' ELSE 'other' END AS domain, ceil(coalesce(strlen(text), 0) / 4.0)::BIGINT AS tokens
      FROM (SELECT *, try_cast(substr(source, 4) AS INT) AS num FROM documents)),
    l AS (SELECT domain, lang, source, sum(tokens)::BIGINT AS supply FROM d GROUP BY ALL),
    budget AS (SELECT floor(sum(supply)::BIGINT * {share}::DOUBLE) AS tokens FROM l),
    {', '.join(steps)},
    p AS (SELECT domain, lang, source, supply, floor(given)::BIGINT AS budget FROM n3 JOIN l USING (domain, lang, source)),
    w AS (SELECT *, least(budget // supply, {epochs})::INT AS whole FROM p WHERE budget > 0),
    r AS (SELECT *, CASE WHEN whole < {epochs} THEN budget - whole * supply ELSE 0 END AS rest FROM w),
    s AS (SELECT doc_id, domain, lang, source, tokens, whole, rest, sum(tokens) OVER (PARTITION BY domain, lang, source
        ORDER BY md5('{MIX_SEED}:' || whole || ':' || doc_id) ROWS UNBOUNDED PRECEDING) AS upto
      FROM d JOIN r USING (domain, lang, source)),
    t AS (SELECT *, whole + CASE WHEN rest > 0 AND coalesce(bool_and(upto <= rest) OVER (PARTITION BY domain, lang,
        source ORDER BY upto, doc_id), true) THEN 1 ELSE 0 END AS times FROM s)
    SELECT doc_id, domain, lang, source, tokens, unnest(range(times))::INT AS epoch FROM t"""


@query(mix_oracle(MIX_SHARE, MIX_EPOCHS))
def op8_mixing(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    levels = mix_levels()
    rows = documents.select(
        "doc_id", levels["domain"].alias("domain"), "lang", "source", token_estimate(F.col("text")).alias("tokens")
    )
    return mix(
        rows,
        {"domain": F.col("domain"), "language": F.col("lang"), "origin": F.col("source")},
        MIX_WEIGHTS,
        F.col("tokens"),
        F.col("doc_id"),
        MIX_SHARE,
        MIX_EPOCHS,
        MIX_SEED,
    )


@query()
def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    return resample(table(spark, folder, "documents").select("doc_id", "text"), good_labels(spark, folder)).select(
        "doc_id", F.round("log_weight", 6).alias("log_weight"), F.round("draw_key", 6).alias("draw_key"), "kept"
    )


def good_labels(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "labels").select(F.col("doc_id").alias("id"), (F.col("quality") == 1).alias("good"))


@query()
def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    documents, benchmark = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    found = documents.select("doc_id", F.explode(overlaps(documents, benchmark)).alias("overlap"))
    return found.select("doc_id", "overlap.*")


@query()
def op4_licences(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    found = documents.select("doc_id", F.explode(licences_in(F.col("text"))).alias("match"))
    return found.select("doc_id", "match.*")


@query()
def op9_html_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url", extracted(F.col("html")).alias("text"))
    return pages.withColumn("n_chars", F.char_length("text").cast("long"))


@query()
def op10_secrets(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    found = written(candidates(documents, "doc_id", "text", F.col("source")), "candidates")
    judged = judge(found, labelled_by_rules(found), texts=documents).withColumnRenamed("id", "doc_id")
    return judged.select(
        "doc_id", "word_at", "nth", F.md5("value").alias("value_md5"), F.round("probability", 6).alias("probability"), "secret"
    )


@query(
    r"""
    WITH lines AS (SELECT doc_id, unnest(line) AS line, unnest(range(len(line))) AS place
      FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS line FROM documents)),
    keyed AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
    shared AS (SELECT key, max(doc_id) AS keep FROM keyed WHERE length(key) >= 20 GROUP BY key
      HAVING count(DISTINCT doc_id) >= 3),
    judged AS (SELECT doc_id, place, line, keep IS NOT NULL AND keep <> doc_id AS dropped FROM keyed LEFT JOIN shared USING (key))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT dropped), '')) AS kept_sha256
    FROM judged GROUP BY doc_id"""
)
def op11_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = drop_shared_lines(table(spark, folder, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query()
def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return repaired_conversations(damaged(conversations), conversations)


@query(
    """
    WITH table_of AS (SELECT list(c ORDER BY i) AS crcs FROM (
      SELECT i, list_reduce(list_prepend(i, range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
      FROM (SELECT unnest(range(256)) AS i))),
    turns AS (SELECT conv_id, turn, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS item,
      strlen(coalesce(text, '')) AS size FROM conversations WHERE conv_id IS NOT NULL),
    own AS (SELECT conv_id, list(item ORDER BY turn NULLS FIRST, item) AS items, list(size ORDER BY turn NULLS FIRST, item) AS sizes
      FROM turns GROUP BY conv_id),
    headed AS (SELECT own.*, xor(4294967295, list_reduce(list_prepend(4294967295,
        list_transform(range(strlen(conv_id::VARCHAR)), lambda i: ord(substr(conv_id::VARCHAR, i + 1, 1))::BIGINT)),
        lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1]))) % 9 AS head FROM own, table_of),
    made AS (SELECT h.conv_id, list_concat(coalesce(b.items[:head], []), h.items[head + 1:]) AS items,
      list_concat(coalesce(b.sizes[:head], []), h.sizes[head + 1:]) AS sizes
      FROM headed h LEFT JOIN own b ON b.conv_id = h.conv_id - h.conv_id % 5),
    passed AS (SELECT conv_id, items, sizes, unnest(range(len(items) + 1)) AS depth FROM made),
    nodes AS (SELECT items[:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(coalesce(sizes[depth], 0)) AS size,
      coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(items) = depth), '') AS ends
      FROM passed GROUP BY ALL),
    linked AS (SELECT n.*, p.conv_id AS parent_conv_id, p.path AS above FROM nodes n
      LEFT JOIN nodes p ON n.depth = p.depth + 1 AND p.path = n.path[:n.depth - 1]),
    children AS (SELECT above AS path, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY above),
    full_nodes AS (SELECT l.*, coalesce(n_children, 0) AS n_children FROM linked l LEFT JOIN children c USING (path)),
    sums AS (SELECT path[:up] AS path, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * size) AS saved
      FROM (SELECT *, unnest(range(depth + 1)) AS up FROM full_nodes) GROUP BY path[:up])
    SELECT conv_id, depth::BIGINT AS depth, parent_conv_id, n_convs, n_children, n_leaves::BIGINT AS n_leaves,
      saved::BIGINT AS saved_tokens, sha256(ends) AS ends_sha256 FROM full_nodes JOIN sums USING (path)"""
)
def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    paths, members = rebuilt(table(spark, folder, "conversations"))
    nodes, met = prefix_trie(paths, members)
    ends = ended_at(members, met).select(F.col("first").alias("of"), F.col("depth").alias("at"), "ends")
    joined = nodes.join(ends, (F.col("member") == F.col("of")) & (F.col("depth") == F.col("at")), "left")
    return joined.select(
        F.col("member").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        F.col("n_members").alias("n_convs"),
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.sha2(F.coalesce("ends", F.lit("")), 256).alias("ends_sha256"),
    )
