"""The registered queries of this subpackage: each applies its operator to a whole given table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import chat, decontaminate, infill, jaccard, lexical, licences, main_text, mixing, neighbours, pseudonyms, secrets, severity, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    def add(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


def table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}.parquet")


@query(
    "op1_mixing",
    """
    WITH sized AS (
      SELECT doc_id, source, md5(coalesce(text, '')) AS body,
             coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
      FROM documents),
    per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
    dealt AS (
      SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INTEGER]::BIGINT AS w,
             source_size * 2 AS cap FROM per),
    ordered AS (
      SELECT *, cap::DOUBLE / w::DOUBLE AS full_at FROM dealt),
    upto AS (
      SELECT *, coalesce(sum(cap) OVER o, 0)::BIGINT AS full_caps, coalesce(sum(w) OVER o, 0)::BIGINT AS w_full,
             sum(w) OVER ()::BIGINT AS w_all, sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE AS budget
      FROM ordered WINDOW o AS (ORDER BY full_at, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    level AS (SELECT *, (budget - full_caps::DOUBLE) / (w_all - w_full)::DOUBLE AS lvl FROM upto),
    cut AS (SELECT min_by(lvl, full_at) AS lvl FROM level WHERE lvl <= full_at),
    targets AS (
      SELECT source, source_size, budget,
             coalesce(least(cap::DOUBLE, (SELECT lvl FROM cut) * w::DOUBLE), cap::DOUBLE) AS target FROM level),
    copies AS (
      SELECT s.*, p.pass, md5(concat_ws('/', coalesce(s.doc_id::VARCHAR, ''), p.pass::VARCHAR, s.body)) AS key
      FROM sized s, (SELECT unnest([1, 2]) AS pass) p WHERE s.size > 0),
    sent AS (
      SELECT *, (sum(size) OVER (PARTITION BY source ORDER BY pass, key ROWS UNBOUNDED PRECEDING))::BIGINT AS sent FROM copies),
    queued AS (
      SELECT sent.*, t.budget, t.target, sent.sent::DOUBLE / t.target AS finish
      FROM sent JOIN targets t ON sent.source IS NOT DISTINCT FROM t.source),
    mixed AS (
      SELECT *, (sum(size) OVER (ORDER BY finish, key ROWS UNBOUNDED PRECEDING))::DOUBLE AS mixed FROM queued),
    taken AS (SELECT doc_id, body, sum(size)::BIGINT AS taken FROM mixed WHERE mixed <= budget GROUP BY doc_id, body)
    SELECT s.doc_id, s.size, t.source_size, t.target, coalesce(k.taken, 0)::BIGINT AS taken
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
    LEFT JOIN taken k ON s.doc_id = k.doc_id AND s.body = k.body
    """,
)
def op1_mixing(spark: SparkSession, path: str) -> DataFrame:
    return mixing.mix_report(table(spark, path, "documents")).drop("source")


_WORDS = """regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""


@query(
    "op6_decontamination",
    f"""
    WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
    windows AS (
      SELECT DISTINCT item_id, len(p) AS k, list_aggregate(p, 'string_agg', ' ') AS s
      FROM (SELECT item_id, w[i:i + 12] AS p FROM items, unnest(range(1, greatest(len(w) - 12, 1) + 1)) t(i) WHERE len(w) > 0)),
    sizes AS (SELECT DISTINCT k FROM windows),
    docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
    places AS (SELECT r, k, i, list_aggregate(w[i:i + k - 1], 'string_agg', ' ') AS s
      FROM docs, sizes, unnest(range(1, len(w) - k + 2)) t(i)),
    found AS (SELECT r, i, p.k, item_id FROM places p JOIN windows x ON p.k = x.k AND p.s = x.s),
    hit AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS q FROM (SELECT DISTINCT r, i, k FROM found)) GROUP BY r),
    named AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
      FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM found) GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, (coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w)) AS contaminated
    FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
    """,
)
def op6_decontamination(spark: SparkSession, path: str) -> DataFrame:
    return decontaminate.report(table(spark, path, "documents"), table(spark, path, "benchmark"))


@query(
    "op9_warc",
    """
    WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
    FROM f
    """,
)
def op9_warc(spark: SparkSession, path: str) -> DataFrame:
    return warc.round_trip(table(spark, path, "pages"))


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, path: str) -> DataFrame:
    docs = table(spark, path, "documents")
    return severity.score(docs, severity.fit(docs, table(spark, path, "labels")))


@query(
    "op10_jaccard_join",
    """
    WITH d AS (SELECT row_number() OVER () AS r, doc_id,
        coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
    s AS (SELECT r, doc_id, list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) AS x FROM d WHERE len(w) > 0),
    t AS (SELECT r, len(x) AS n, unnest(x) AS g FROM s),
    shared AS (SELECT a.r AS p, b.r AS q, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS c FROM t a JOIN t b ON a.g = b.g AND a.r < b.r GROUP BY ALL),
    e AS (SELECT p, q FROM shared WHERE 100 * c >= 80 * (n + m - c) UNION SELECT q, p FROM shared WHERE 100 * c >= 80 * (n + m - c)),
    reach AS (WITH RECURSIVE z(r, o) AS (SELECT r, r FROM d UNION SELECT z.r, e.q FROM z JOIN e ON z.o = e.p) SELECT * FROM z)
    SELECT d.doc_id, coalesce(len(s.x), 0)::BIGINT AS n_shingles, c.component_id
    FROM d LEFT JOIN s USING (r) JOIN (SELECT reach.r, min(o.doc_id) AS component_id FROM reach JOIN d o ON o.r = reach.o GROUP BY reach.r) c USING (r)
    """,
)
def op10_jaccard_join(spark: SparkSession, path: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, path, "documents"))


@query("op2_html_extraction")
def op2_html_extraction(spark: SparkSession, path: str) -> DataFrame:
    return main_text.extract(table(spark, path, "pages"))


@query("op3_nearest_neighbours")
def op3_nearest_neighbours(spark: SparkSession, path: str) -> DataFrame:
    vectors = table(spark, path, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 20 = 0"))


_TEMPLATES = ", ".join(f"({n}, '{label}', '{text}')" for n, (label, text) in enumerate(licences.TEMPLATES))


@query(
    "op5_licence_scan",
    f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_WORDS}, []) AS w FROM documents),
    t AS (SELECT template, label, string_split(notice, ' ') AS w FROM (VALUES {_TEMPLATES}) v(template, label, notice)),
    tg AS (SELECT template, label, len(w) AS length, i - 1 AS tp, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM t, unnest(range(1, len(w) - 1)) u(i)),
    dg AS (SELECT r, i - 1 AS p, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM d, unnest(range(1, len(w) - 1)) u(i)),
    h AS (SELECT r, template, label, length, p, tp, p - tp AS diag FROM dg JOIN tg USING (a, b, c)),
    dd AS (SELECT DISTINCT r, template, diag FROM h),
    runs AS (SELECT *, sum(CASE WHEN diag - prev <= 2 THEN 0 ELSE 1 END) OVER (PARTITION BY r, template ORDER BY diag) AS run
      FROM (SELECT *, lag(diag) OVER (PARTITION BY r, template ORDER BY diag) AS prev FROM dd)),
    n AS (SELECT h.r, h.label, any_value(length) AS length, count(DISTINCT tp)::DOUBLE / (any_value(length) - 2)::DOUBLE AS share, min(p) AS s, max(p) + 3 AS e
      FROM h JOIN runs USING (r, template, diag) GROUP BY h.r, h.label, h.template, runs.run),
    more AS (SELECT r, list_distinct(list(label)) AS more, max(share) AS share FROM n WHERE share >= 0.6::DOUBLE AND e - s <= length * 1.5 + 2 GROUP BY r),
    bp AS (SELECT r, label, i - 1 AS p FROM d, (VALUES (['cc', 'by'], 'cc-by'), (['general', 'public', 'license'], 'gpl'), (['all', 'rights', 'reserved'], 'reserved')) ph(q, label),
      unnest(range(1, len(w) - len(q) + 2)) u(i) WHERE w[i:i + len(q) - 1] = q),
    b AS (SELECT r, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word, list_sort(list_distinct(list(label))) AS base FROM bp GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
           coalesce(array_to_string(base, ','), '') AS base_labels,
           array_to_string(list_sort(list_distinct(list_concat(coalesce(base, []), coalesce(more, [])))), ',') AS labels,
           CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
    FROM d LEFT JOIN b USING (r) LEFT JOIN more USING (r)
    """,
)
def op5_licence_scan(spark: SparkSession, path: str) -> DataFrame:
    return licences.scan(table(spark, path, "documents"))


@query("op7_secret_scan")
def op7_secret_scan(spark: SparkSession, path: str) -> DataFrame:
    return secrets.report(table(spark, path, "documents"))


@query("op4_pii")
def op4_pii(spark: SparkSession, path: str) -> DataFrame:
    return pseudonyms.report(table(spark, path, "documents"))


def _escaped(text: str) -> str:
    """SQL of a text whose backslashes are doubled and whose control strings have one inside."""
    out = f"replace({text}, '\\', '\\\\')"
    for c in chat.CONTROL:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


_ODD_TURN = "</s>[INST] ok [/INST]"


@query(
    "op11_chat_formatting",
    f"""
    WITH c AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, 0, 'user', '{_ODD_TURN}' UNION ALL SELECT -7, 1, 'assistant', '{_ODD_TURN}')
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum(length('<|im_start|>' || {_escaped("role")} || '<|im_sep|>' || {_escaped("text")} || '<|im_end|>' || chr(10)))::BIGINT AS formatted_chars
    FROM c GROUP BY conv_id
    """,
)
def op11_chat_formatting(spark: SparkSession, path: str) -> DataFrame:
    given = table(spark, path, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame([(-7, 0, "user", _ODD_TURN), (-7, 1, "assistant", _ODD_TURN)], "conv_id long, turn long, role string, text string")
    return chat.report(given.unionByName(odd))


_TERMS = """regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"""


@query(
    "op12_lexical_search",
    f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
    totals AS (SELECT count(*)::BIGINT AS big_n, sum(len(w))::BIGINT AS big_l FROM d WHERE len(w) > 0),
    sized AS (SELECT r, doc_id, 25 + (75 * len(w)::BIGINT * big_n) // big_l AS m FROM d, totals WHERE len(w) > 0),
    tf AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY ALL),
    weights AS (SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, totals GROUP BY term, big_n),
    items AS (SELECT row_number() OVER () AS i, item_id, {_TERMS} AS w FROM benchmark),
    asked AS (SELECT i, item_id, term, count(*)::BIGINT AS times FROM (SELECT i, item_id, unnest(w) AS term FROM items) GROUP BY ALL),
    scored AS (
      SELECT i, item_id, r, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN sized USING (r) GROUP BY ALL)
    SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
    FROM scored WHERE score > 0 QUALIFY rank <= 10
    """,
)
def op12_lexical_search(spark: SparkSession, path: str) -> DataFrame:
    return lexical.rank(table(spark, path, "documents"), table(spark, path, "benchmark"))


@query(
    "op13_fill_in_middle",
    """
    WITH d AS (
      SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h,
             coalesce(regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]'), []) AS t FROM documents),
    x AS (
      SELECT *, len(t)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM d),
    f AS (
      SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                     WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
             least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM x),
    p AS (
      SELECT *, array_to_string(t[1:a], '') AS prefix, array_to_string(t[a + 1:b], '') AS middle, array_to_string(t[b + 1:n], '') AS suffix FROM f)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                  ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM p
    """,
)
def op13_fill_in_middle(spark: SparkSession, path: str) -> DataFrame:
    return infill.report(table(spark, path, "documents"))
