"""The operators on the driver's tables, each with its parameters and, where SQL can express it, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tailrace.llm import bpe, decontaminate, kd_shards, lm, merkle, near_dup, preference, quality, repair, repeats, surrogates, topk, warc
from tailrace.llm.tables import fold, source

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


@query(
    """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
      FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    ), s AS (
      SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
             CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
      FROM v q JOIN v c ON len(q.v) = len(c.v) AND q.vec_id <> c.vec_id
      WHERE q.vec_id % 20 = 0
    ), r AS (
      SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
    )
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
    """
)
def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantized(source(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.where("vec_id % 20 = 0"))


@query()
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(source(spark, sf_dir, "documents"), vocabulary(), ids=False)


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


WORDS_SQL = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"


@query(
    f"""
    WITH RECURSIVE w AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
    s AS (
      SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN []
        WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
      FROM w
    ), e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
    link AS (
      SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
    ), reach AS (
      SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b
    ), c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
    SELECT doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM s JOIN c USING (doc_id)
    """
)
def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(source(spark, sf_dir, "documents"), k=4)


@query()
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(source(spark, sf_dir, "documents"), source(spark, sf_dir, "benchmark"))


@query()
def op1_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = source(spark, sf_dir, "documents").select("doc_id", "text")
    model, _ = trained_quality(docs, sf_dir)
    return quality.scored(docs, model).select("doc_id", (fold() == 0).alias("held_out"), "score", "predicted")


def trained_quality(docs: DataFrame, sf_dir: str) -> tuple[quality.Model, float]:
    """Trusted positives are labels of quality 1, unlabelled text is all documents; neither from fold 0."""
    labels = source(docs.sparkSession, sf_dir, "labels")
    return quality.train(docs, labels.where((F.col("quality") == 1) & (fold() != 0)), docs.where(fold() != 0))


@query()
def op7_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scores(source(spark, sf_dir, "documents"), fold(parts=10) == 0)


@query(
    """
    WITH p AS (
      SELECT page_id, encode(coalesce(html, '')) AS payload, row_number() OVER () AS row FROM pages
    ), d AS (
      SELECT page_id, row, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS hex FROM p
    ), b AS (
      SELECT *, array_to_string(list_transform(range(0, 32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
          ((CAST(('0x' || substr(hex, CAST(i * 5 // 4 AS BIGINT) + 1, 2) || repeat('0', 1 - CAST(i * 5 // 4 < 39 AS INTEGER))) AS INTEGER)
            >> CAST(3 - i * 5 % 4 AS INTEGER)) & 31) + 1 AS BIGINT), 1)), '') AS payload_digest
      FROM d
    ), f AS (
      SELECT *, first_value(page_id) OVER w AS first_page, row_number() OVER w AS place FROM b
      WINDOW w AS (PARTITION BY hex, payload_bytes ORDER BY page_id NULLS LAST, row)
    )
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN place > 1 THEN first_page END AS refers_to FROM f
    """
)
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = source(spark, sf_dir, "pages").select("page_id", "url", F.encode("html", "UTF-8").alias("payload"))
    _, chunks = warc.archived(pages)
    return chunks.where("last").select("page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to")


@query()
def op4_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = source(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit("")).cast("binary")  # dimensions of the text alone: its copies are one point
    dimensions = [F.octet_length(text), F.crc32(F.col("lang").cast("binary")), F.crc32(text)]
    placed = kd_shards.kd_shards(docs, dimensions, shards=8, exact=0.02)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def _rendered(turns: str) -> str:
    return f"array_to_string(list_transform({turns}, lambda t: t.head || t.body || chr(10)), '')"


def _spans(turns: str) -> str:
    """Start and end of the assistant's texts, as text."""
    before = f"coalesce(list_sum(list_transform({turns}[:i - 1], lambda t: length(t.head) + length(t.body) + 1)), 0) + length({turns}[i].head)"
    span = f"CAST({before} AS BIGINT) || ':' || CAST({before} + length({turns}[i].body) AS BIGINT)"
    return f"array_to_string(list_transform(list_filter(range(1, len({turns}) + 1), lambda i: {turns}[i].role = 'assistant'), lambda i: {span}), ',')"


@query(
    f"""
    WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
    c AS (
      SELECT conv_id, list({{'role': role, 'text': text, 'head': '<|' || coalesce(role, '') || '|>' || chr(10),
        'body': replace(coalesce(text, ''), '<|', '< |') || '<|end|>'}} ORDER BY turn NULLS LAST, role NULLS FIRST, text NULLS FIRST) AS turns
      FROM t GROUP BY conv_id
    ), p AS (
      SELECT a.conv_id, a.turns AS chosen,
             list_concat(a.turns[:-2], CASE WHEN b.turns IS NULL THEN [] ELSE b.turns[-1:] END) AS rejected
      FROM c a LEFT JOIN c b ON b.conv_id = xor(a.conv_id, 1)
    ), n AS (
      SELECT *, CAST(coalesce(list_min(list_filter(range(1, least(len(chosen), len(rejected)) + 1), lambda i:
        chosen[i].role IS DISTINCT FROM rejected[i].role OR chosen[i].text IS DISTINCT FROM rejected[i].text)) - 1,
        least(len(chosen), len(rejected))) AS INTEGER) AS n_common
      FROM p
    ), r AS (SELECT conv_id, n_common, chosen[:n_common] AS shared, chosen[n_common + 1:] AS c, rejected[n_common + 1:] AS r FROM n)
    SELECT conv_id, n_common, {_rendered("shared")} AS prompt, {_rendered("c")} AS chosen, {_spans("c")} AS chosen_mask,
           {_rendered("r")} AS rejected, {_spans("r")} AS rejected_mask
    FROM r
    """
)
def op9_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = preference.mismatched(preference.conversations_of(source(spark, sf_dir, "conversations")))
    mask = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"], s["end"])), ",").alias(c)
    return preference.preference_pairs(pairs).select(
        "conv_id", "n_common", "prompt", F.col("chosen_text").alias("chosen"), mask("chosen_mask"), F.col("rejected_text").alias("rejected"), mask("rejected_mask")
    )


SURROGATE_KEY = "a key of the owner's; this one is for the driver's tables"


@query()
def op5_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = source(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.surrogated(docs, SURROGATE_KEY)


def _crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text; the constants are the reversed polynomial and the mask of all bits."""
    step = "list_reduce(list_concat([xor(a, b)], range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)"
    codes = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    return f"xor(list_reduce(list_concat([4294967295], {codes}), lambda a, b: {step}), 4294967295)"


def _leaf_sql(text: str) -> str:
    part = "coalesce(octet_length(encode(CAST({0} AS VARCHAR))) || ':' || CAST({0} AS VARCHAR), '-')".format
    return f"sha256({' || '.join(part(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


_PARENTS_SQL = "list_transform(range(0, len(nodes), 3), lambda i: sha256(array_to_string(nodes[i + 1:i + 3], '')))"


@query(
    f"""
    WITH RECURSIVE d AS (
      SELECT doc_id, source, {_leaf_sql("text")} AS leaf, CASE WHEN coalesce({_crc32_sql("CAST(doc_id AS VARCHAR)")} % 2 = 0, false)
        THEN {_leaf_sql("replace(text, chr(10), '')")} ELSE {_leaf_sql("text")} END AS tampered
      FROM documents
    ), p AS (
      SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS grp,
             row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, tampered) - 1 AS pos
      FROM d
    ), t AS (
      SELECT grp, 0 AS level, list(leaf ORDER BY pos) AS nodes FROM p GROUP BY grp
      UNION ALL SELECT grp, level + 1, {_PARENTS_SQL} FROM t WHERE len(nodes) > 1
    ), s AS (
      SELECT 0 AS level, list(nodes[1] ORDER BY grp) AS nodes FROM t WHERE len(nodes) = 1
      UNION ALL SELECT level + 1, {_PARENTS_SQL} FROM s WHERE len(nodes) > 1
    ), way AS (
      SELECT p.grp, p.pos, t.level, t.nodes, CAST(p.pos // CAST(pow(3, t.level) AS BIGINT) AS BIGINT) AS place
      FROM p JOIN t ON t.grp = p.grp WHERE len(t.nodes) > 1
      UNION ALL SELECT p.grp, p.pos, 1000 + s.level, s.nodes, CAST(p.grp // CAST(pow(3, s.level) AS BIGINT) AS BIGINT)
      FROM p CROSS JOIN s WHERE len(s.nodes) > 1
    ), w AS (
      SELECT grp, pos, list({{'cur': '', 'run': nodes[place // 3 * 3 + 1:place // 3 * 3 + 3], 'j': place % 3}} ORDER BY level) AS steps FROM way GROUP BY grp, pos
    ), f AS (
      SELECT p.doc_id, p.leaf, (SELECT nodes[1] FROM t WHERE t.grp = p.grp AND len(nodes) = 1) AS subroot,
             (SELECT nodes[1] FROM s WHERE len(nodes) = 1) AS root,
             sha256(coalesce(array_to_string(list_transform(steps, lambda x: array_to_string(list_concat(x.run[:x.j], x.run[x.j + 2:]), '')), ''), '')) AS proof_sha256,
             list_reduce(list_concat([{{'cur': tampered, 'run': CAST([] AS VARCHAR[]), 'j': CAST(0 AS BIGINT)}}], coalesce(steps, [])), lambda a, b: {{
               'cur': sha256(array_to_string(list_concat(list_concat(b.run[:b.j], [a.cur]), b.run[b.j + 2:]), '')), 'run': b.run, 'j': b.j}}).cur AS folded_root
      FROM p LEFT JOIN w USING (grp, pos)
    )
    SELECT *, folded_root = root AS verified FROM f
    """
)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.documents_manifest(source(spark, sf_dir, "documents"), fold(parts=2) == 0)


def _added(label: str, cost: str, letter: str) -> str:
    """A walk, as six digits of cost and its audit, with one more edit; '~' is no walk."""
    return f"CASE WHEN {label} = '~' THEN '~' ELSE lpad(CAST(CAST(substr({label}, 1, 6) AS INTEGER) + {cost} AS VARCHAR), 6, '0') || substr({label}, 7) || '{letter}' END"


def _inserted(columns: str, relation: str) -> str:
    """The least walks to the four roles when turns may still be inserted."""
    user = f"least(c2, {_added('least(c0, c1, c3)', '3', 'I')})"
    return f"SELECT {columns}, c0 AS l0, c1 AS l1, c2 AS l2, least(c3, {_added('c2', '3', 'I')}) AS l3 FROM (SELECT {columns}, c0, c1, {user} AS c2, c3 FROM {relation})"


_KEPT = "CASE WHEN r.cut THEN 3 ELSE 0 END"
_RETYPED = "CASE WHEN r.cut THEN 6 ELSE 3 END"
_STEP_SQL = f"""
    SELECT r.conv_id, r.i, {_added("l0", "4", "D")} AS c0,
           least({_added("l1", "4", "D")}, CASE WHEN NOT r.bad AND r.initial = 's' THEN {_added("l0", _KEPT, "K")} ELSE '~' END) AS c1,
           least({_added("l2", "4", "D")}, CASE WHEN NOT r.bad AND r.initial = 'u' THEN {_added("least(l0, l1, l3)", _KEPT, "K")} ELSE '~' END,
                 CASE WHEN NOT r.bad THEN {_added("least(l0, l1, l3)", _RETYPED, "R")} ELSE '~' END) AS c2,
           least({_added("l3", "4", "D")}, CASE WHEN NOT r.bad AND r.initial = 'a' THEN {_added("l2", _KEPT, "K")} ELSE '~' END,
                 CASE WHEN NOT r.bad THEN {_added("l2", _RETYPED, "R")} ELSE '~' END) AS c3
    FROM w JOIN r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i + 1
"""


@query(
    f"""
    WITH RECURSIVE o AS (
      SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             {_crc32_sql("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS f
      FROM conversations
    ), m AS (
      SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
             CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN f = 3 THEN 2 ELSE 1 END)) AS copy
      FROM o WHERE f <> 0
    ), n AS (
      SELECT *, substr(role, 1, 1) AS initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
      FROM m
    ), g AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again FROM n), r AS (
      SELECT conv_id, turn, role, text, initial, i, body = '' AS blank, again, body = '' OR again AS bad, body <> '' AND right(body, 1) NOT IN ('.', '!', '?') AS cut,
             lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair
      FROM g
    ), w AS (
      {_inserted("conv_id, i", "(SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, '000000' AS c0, '~' AS c1, '~' AS c2, '~' AS c3 FROM conversations)")}
      UNION ALL {_inserted("conv_id, i", f"({_STEP_SQL})")}
    ), e AS (
      SELECT conv_id, CAST(substr(least(l0, l3), 1, 6) AS BIGINT) AS cost, substr(least(l0, l3), 7) AS audit
      FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS back FROM w) WHERE back = 1
    ), a AS (SELECT conv_id, unnest(string_split(audit, '')) AS op, unnest(range(1, length(audit) + 1)) AS j FROM e WHERE audit <> ''),
    q AS (
      SELECT *, CASE WHEN op <> 'I' THEN sum(CAST(op <> 'I' AS INTEGER)) OVER (PARTITION BY conv_id ORDER BY j) END AS i,
             sum(CAST(op <> 'D' AS INTEGER)) OVER (PARTITION BY conv_id ORDER BY j) AS place
      FROM a
    ), k AS (
      SELECT q.conv_id, q.op, q.place, r.role, r.text, max(CASE WHEN q.op = 'K' AND q.place = 1 AND r.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY q.conv_id) AS lead
      FROM q LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM q.conv_id AND r.i = q.i WHERE q.op <> 'D'
    ), h AS (
      SELECT conv_id, string_agg(CASE WHEN op = 'K' THEN role WHEN (place - lead) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN op = 'I' THEN '' ELSE text END, chr(10) ORDER BY place) AS lines
      FROM k GROUP BY conv_id
    ), c AS (
      SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
             count(*) FILTER (again AND NOT blank) AS duplicate, count(*) FILTER (cut AND NOT bad) AS truncated,
             count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
      FROM r GROUP BY conv_id
    )
    SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
           coalesce(illegal, 0) AS illegal, cost, audit, sha256(coalesce(lines, '')) AS repaired_sha256
    FROM e LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN h ON h.conv_id IS NOT DISTINCT FROM e.conv_id
    """
)
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repaired(*repair.damaged(source(spark, sf_dir, "conversations")))


@query(
    """
    WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
    piece AS (SELECT doc_id, n, a, substr(h, 2 * a + 1, 2198) AS p FROM (SELECT *, unnest(range(0, n - 99, 1000)) AS a FROM t)),
    w AS (SELECT doc_id, a + i AS s, substr(p, 2 * i + 1, 200) AS w FROM (SELECT *, unnest(range(0, least(1000, n - 99 - a))) AS i FROM piece)),
    again AS (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY w ORDER BY doc_id, s) AS place FROM w) WHERE place > 1),
    run AS (
      SELECT doc_id, s, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS run
      FROM (SELECT *, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100 THEN 0 ELSE 1 END AS new FROM again)
    ), span AS (SELECT doc_id, min(s) AS a, max(s) + 100 AS b FROM run GROUP BY doc_id, run),
    gap AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS c FROM span),
    kept AS (
      SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last, string_agg(substr(h, 2 * c + 1, 2 * (a - c)), '' ORDER BY a) AS body
      FROM gap JOIN t USING (doc_id) GROUP BY doc_id
    )
    SELECT t.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
           sha256(unhex(coalesce(body, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
    FROM t LEFT JOIN kept ON kept.doc_id = t.doc_id
    """
)
def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeats.without_repeats(source(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return kept.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
