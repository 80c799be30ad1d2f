"""DuckDB SQL for the correctness cross-check of the registered queries.

Independent formulation of the same semantics in DuckDB's dialect (RE2
regexes, list lambdas), used only by ``__spark_entry__.oracle_sql`` and the
tests. RE2 has no possessive or look-behind constructs, so it runs the
published pattern forms; its ``\\b`` is ASCII-only, so non-ASCII letters are
mapped to ``_`` (a word character outside ``[A-Za-z]``, one code point for
one) before matching, and entity text is cut from the original text by
offset. The EMAIL patterns run on the unmapped text (``_`` belongs to the
e-mail local-part class).
"""

from __future__ import annotations

from ..functions.patterns import CATALOGUE, DEFAULT_CONFIDENCE, FALSE_POSITIVES
from ..functions.strategies import DEFAULT_PLACEHOLDER, PLACEHOLDERS, available_strategies
from .payload_files import CONVERSATIONS_PER_FILE, MIXED_KINDS, TURNS_PER_FILE
from .views import CORPUS_SQL, FINDING_RULES, GIVEN_SQL, PAYLOADS_SQL

NON_ASCII_LETTERS = (r"[\x{00AA}\x{00B5}\x{00BA}\x{00C0}-\x{00D6}\x{00D8}-\x{00F6}"
                     r"\x{00F8}-\x{024F}\x{0370}-\x{1FFF}\x{3040}-\x{D7FF}]")
RANK_STRIDE = 4294967296


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _fp_filter(col: str, et: str) -> str:
    conds = []
    for t, fps in FALSE_POSITIVES.items():
        vals = ", ".join(q(v.lower()) for v in dict.fromkeys(fps))
        conds.append(f"NOT ({et} = {q(t)} AND lower({col}) IN ({vals}))")
    return " AND ".join(conds)


def candidates_ctes(inp: str, patterns=CATALOGUE, conf: float = DEFAULT_CONFIDENCE,
                    name: str = "cand") -> str:
    """CTEs ending in ``{name}(src, key, ord, et, start_pos, end_pos, etext, rank,
    conf, source)``: validated raw regex candidates of the rows of ``inp``
    (columns src, key, text)."""
    parts = []
    for p in patterns:
        uu = "text" if p.entity_type == "EMAIL" else "u"
        rx = p.plain
        parts.append(
            f"SELECT src, key, text, {p.ordinal} AS ord, {q(p.entity_type)} AS et, "
            f"regexp_extract_all({uu}, {q(rx)}, 0, 'i') AS m, "
            f"string_split_regex({uu}, {q('(?i)' + rx)}) AS g, "
            f"regexp_extract_all({uu}, {q(rx)}, {p.plain_group}, 'i') AS x FROM {name}_in")
    union = "\nUNION ALL\n".join(parts)
    return f"""
{name}_in AS (
  SELECT src, key, text, regexp_replace(text, {q(NON_ASCII_LETTERS)}, '_', 'g') AS u
  FROM {inp} WHERE text IS NOT NULL),
{name}_pm AS ({union}),
{name}_pe AS (
  SELECT src, key, text, ord, et, i,
         length(array_to_string(g[1:i], '')) + length(array_to_string(m[1:i], '')) AS e_end,
         x[i] AS xi
  FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM {name}_pm)),
{name}_raw AS (
  SELECT src, key, ord, et,
         CAST(e_end - length(xi) AS INTEGER) AS start_pos, CAST(e_end AS INTEGER) AS end_pos,
         substring(text, e_end - length(xi) + 1, length(xi)) AS etext,
         CAST(ord AS BIGINT) * {RANK_STRIDE} + (i - 1) AS rank,
         CAST({conf!r} AS DOUBLE) AS conf, 'REGEX' AS source
  FROM {name}_pe),
{name} AS (
  SELECT * FROM {name}_raw
  WHERE length(regexp_replace(etext, '^\\s+|\\s+$', '', 'g')) >= 2
    AND {_fp_filter('etext', 'et')})"""


ENTITY_STRUCT = "{'s': start_pos, 'r': rank, 'e': end_pos, 't': etext, 'y': et, 'c': conf, 'o': source}"

M3_LAMBDA = ("lambda acc, x: CASE WHEN len(acc) = 0 OR NOT (x.s < acc[-1].e AND x.e > acc[-1].s) "
             "THEN list_append(acc, x) WHEN x.c > acc[-1].c THEN list_append(acc[:-2], x) "
             "ELSE acc END")


def kept_ctes(cand: str = "cand", name: str = "kept") -> str:
    """``{name}(src, key, k)``: overlap-resolved entity list per row (rows with
    candidates only), sorted by start."""
    return f"""
{name}_l AS (
  SELECT src, key, list({ENTITY_STRUCT} ORDER BY start_pos, rank) AS l
  FROM {cand} GROUP BY src, key),
{name} AS (SELECT src, key, list_reduce(l, {M3_LAMBDA}, l[:0]) AS k FROM {name}_l)"""


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def _stars(n: str) -> str:
    return f"repeat('*', CAST(greatest({n}, 0) AS BIGINT))"


def _default_partial(s: str) -> str:
    n = f"length({s})"
    return (f"CASE WHEN {n} <= 2 THEN {_stars(n)} ELSE "
            f"substring({s}, 1, 1) || {_stars(n + ' - 2')} || right({s}, 1) END")


def strategy_sql(name: str, t: str = "x.t", y: str = "x.y") -> str:
    if name == "placeholder":
        cases = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in PLACEHOLDERS.items())
        return f"(CASE {y} {cases} ELSE {q(DEFAULT_PLACEHOLDER)} END)"
    if name == "remove":
        return "''"
    if name == "hash":
        return f"('[' || {y} || '_' || substring(md5({t}), 1, 8) || ']')"
    s = strip_sql(t)
    n = f"length({s})"
    if name == "mask":
        return (f"(CASE WHEN {n} <= 2 THEN {_stars(n)} "
                f"WHEN {n} <= 4 THEN substring({s}, 1, 1) || {_stars(n + ' - 2')} || right({s}, 1) "
                f"ELSE substring({s}, 1, 2) || {_stars(n + ' - 3')} || right({s}, 1) END)")
    if name == "partial":
        user = f"split_part({s}, '@', 1)"
        domain = f"substring({s}, length({user}) + 2)"
        d = f"regexp_replace({s}, '[^0-9]', '', 'g')"
        email = (f"CASE WHEN contains({s}, '@') THEN "
                 f"(CASE WHEN length({user}) = 0 THEN '*' ELSE substring({user}, 1, 1) || "
                 f"{_stars('length(' + user + ') - 1')} END) || '@' || {domain} "
                 f"ELSE {_default_partial(s)} END")
        phone = (f"CASE WHEN length({d}) >= 4 THEN '***-***-' || right({d}, 4) "
                 f"ELSE {_default_partial(s)} END")
        card = (f"CASE WHEN length({d}) >= 4 THEN '****-****-****-' || right({d}, 4) "
                f"ELSE {_default_partial(s)} END")
        return (f"(CASE WHEN {y} = 'EMAIL' THEN {email} WHEN {y} = 'PHONE' THEN {phone} "
                f"WHEN {y} = 'CREDIT_CARD' THEN {card} ELSE {_default_partial(s)} END)")
    raise ValueError(name)


def splice_sql(text: str, kept: str, strategy: str) -> str:
    """Right-to-left splice of an ascending, disjoint entity list."""
    rep = strategy_sql(strategy, "x.t", "x.y")
    return (f"list_reduce(list_reverse({kept}), lambda acc, x: substring(acc, 1, x.s) || {rep} "
            f"|| substring(acc, x.e + 1), {text})")


def with_views(body: str, *ctes: str) -> str:
    parts = [f"corpus AS ({CORPUS_SQL})", f"payloads AS ({PAYLOADS_SQL})",
             f"findings AS ({FINDINGS_SQL})"]
    parts += [c.strip() for c in ctes if c.strip()]
    return "WITH " + ",\n".join(parts) + "\n" + body


def _finding(needle: str, shift: int, length: int, etype: str, score: float, source: str) -> str:
    begin = (f"sum(length(gap)) OVER (PARTITION BY src, key ORDER BY i) + i * {len(needle)} + {shift}")
    return (f"SELECT src, key, 'text' AS field_name, CAST({begin} AS INTEGER) AS begin_offset, "
            f"CAST({begin} + {length} AS INTEGER) AS end_offset, "
            f"{q(etype)} AS type, CAST({score!r} AS DOUBLE) AS score, {q(source)} AS source "
            f"FROM (SELECT src, key, unnest(g[1:len(g) - 1]) AS gap, unnest(range(len(g) - 1)) AS i "
            f"FROM (SELECT src, key, string_split(text, {q(needle)}) AS g FROM corpus))")


FINDINGS_SQL = "\nUNION ALL\n".join(_finding(*r) for r in FINDING_RULES)


SOURCE_ORD = "CASE source WHEN 'COMPREHEND' THEN 100 WHEN 'CER' THEN 101 ELSE 999 END"

FINDING_ENTITIES_CTE = f"""
fent AS (
  SELECT f.src, f.key, CAST(NULL AS INTEGER) AS ord, f.type AS et,
         f.begin_offset AS start_pos, f.end_offset AS end_pos,
         substring(c.text, f.begin_offset + 1, f.end_offset - f.begin_offset) AS etext,
         CAST({SOURCE_ORD.replace('source', 'f.source')} AS BIGINT) * {RANK_STRIDE}
           + (row_number() OVER (PARTITION BY f.src, f.key
                ORDER BY {SOURCE_ORD.replace('source', 'f.source')}, f.begin_offset,
                         f.end_offset, f.type) - 1) AS rank,
         f.score AS conf, f.source AS source
  FROM findings f JOIN corpus c ON f.src = c.src AND f.key = c.key)"""

EXPLODE_KEPT = ("SELECT src, key, x.y AS entity_type, x.s AS start_pos, x.e AS end_pos, "
                "x.t AS text, x.c AS confidence, x.o AS source "
                "FROM (SELECT src, key, unnest(k) AS x FROM kept)")


def detect_sql(ordinals) -> str:
    pats = [p for p in CATALOGUE if p.ordinal in ordinals]
    return with_views(
        "SELECT src, key, CAST(ord AS INTEGER) AS pattern_id, start_pos, end_pos, etext AS text "
        "FROM cand", candidates_ctes("corpus", pats))


def redact_sql(strategy: str) -> str:
    return with_views(
        f"SELECT c.src, c.key, coalesce({splice_sql('c.text', 'kept.k', strategy)}, c.text) "
        f"AS redacted_text, CAST(coalesce(len(kept.k), 0) AS INTEGER) AS n_redacted "
        f"FROM corpus c LEFT JOIN kept ON c.src = kept.src AND c.key = kept.key",
        candidates_ctes("corpus"), kept_ctes())


def with_views_fent(body: str, *ctes: str) -> str:
    return with_views(body, FINDING_ENTITIES_CTE, *ctes)


def oracle_queries(detect_groups: dict) -> dict:
    out = {name: detect_sql(ords) for name, ords in detect_groups.items()}
    out["entities_merged"] = with_views(EXPLODE_KEPT, candidates_ctes("corpus"), kept_ctes())
    out["entities_hybrid"] = with_views(
        EXPLODE_KEPT, candidates_ctes("corpus"), FINDING_ENTITIES_CTE,
        "allc AS (SELECT * FROM cand UNION ALL BY NAME SELECT * FROM fent)",
        kept_ctes("allc"))
    out["overlap_report"] = with_views(
        """SELECT c.src, c.key, CAST(coalesce(r.n_candidates, 0) AS INTEGER) AS n_candidates,
                  CAST(coalesce(r.n_overlapping, 0) AS INTEGER) AS n_overlapping,
                  CAST(coalesce(len(kept.k), 0) AS INTEGER) AS n_kept
           FROM corpus c
           LEFT JOIN (SELECT src, key, count(*) AS n_candidates,
                             count_if(start_pos < coalesce(pm, -1)) AS n_overlapping
                      FROM (SELECT src, key, start_pos,
                                   max(end_pos) OVER (PARTITION BY src, key ORDER BY start_pos, rank
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm
                            FROM cand) GROUP BY src, key) r ON c.src = r.src AND c.key = r.key
           LEFT JOIN kept ON c.src = kept.src AND c.key = kept.key""",
        candidates_ctes("corpus"), kept_ctes())
    for s in ("placeholder", "mask", "remove", "hash", "partial"):
        out[f"redact_{s}"] = redact_sql(s)
    rep = strategy_sql("placeholder", "x.t", "x.y")
    out["redact_with_entities"] = with_views_fent(
        f"""SELECT c.src, c.key,
                   coalesce(list_reduce(fl.l, lambda acc, x: substring(acc, 1, x.s) || {rep}
                            || substring(acc, x.e + 1), c.text), c.text) AS redacted_text,
                   CAST(coalesce(len(fl.l), 0) AS INTEGER) AS n_redacted
            FROM corpus c LEFT JOIN fl ON c.src = fl.src AND c.key = fl.key""",
        f"""fl AS (SELECT src, key,
                   list({{'s': start_pos, 'e': end_pos, 't': etext, 'y': et}}
                        ORDER BY start_pos DESC, rank) AS l
                 FROM fent GROUP BY src, key)""")
    out["redaction_records"] = with_views(
        f"""SELECT src, key, CAST(i AS INTEGER) AS rec_ord, x.t AS original_text,
                   x.y AS entity_type, x.s AS start_pos, x.e AS end_pos, {rep} AS replacement,
                   x.c AS confidence, x.o AS source
            FROM (SELECT src, key, unnest(range(len(k))) AS i, unnest(list_reverse(k)) AS x
                  FROM kept)""",
        candidates_ctes("corpus"), kept_ctes())
    pf = ("pf AS (SELECT 'sentence' AS src, verbatim_id AS key, sentence AS text FROM payloads "
          "UNION ALL SELECT 'notes' AS src, verbatim_id AS key, notes AS text FROM payloads)")
    per_payload = f"""
pk AS (
  SELECT p.verbatim_id, p.call_id, p.ordinal, p.sentence, p.notes, ks.k AS ks, kn.k AS kn,
         coalesce(len(ks.k), 0) AS ns, coalesce(len(kn.k), 0) AS nn
  FROM payloads p
  LEFT JOIN kept ks ON ks.src = 'sentence' AND ks.key = p.verbatim_id
  LEFT JOIN kept kn ON kn.src = 'notes' AND kn.key = p.verbatim_id)"""
    out["payload_redaction"] = with_views(
        f"""SELECT verbatim_id,
                   coalesce({splice_sql('sentence', 'ks', 'placeholder')}, sentence) AS sentence,
                   coalesce({splice_sql('notes', 'kn', 'placeholder')}, notes) AS notes,
                   CASE WHEN ns + nn > 0 THEN CAST(ns + nn AS INTEGER) END AS redaction_count,
                   CASE WHEN ns + nn > 0 THEN 'placeholder' END AS strategy_used,
                   CASE WHEN ns + nn > 0 THEN CAST(nn AS INTEGER) END AS notes_records
            FROM pk""",
        pf, candidates_ctes("pf"), kept_ctes(), per_payload)
    file_id = (f"CAST(call_id // {CONVERSATIONS_PER_FILE} AS BIGINT) * 100000 "
               f"+ CAST(ordinal // {TURNS_PER_FILE} AS BIGINT)")
    file_rows = f"""SELECT {file_id} AS file_id,
                          CAST(count(*) AS BIGINT) AS total_payloads,
                          CAST(sum(ns + nn) AS BIGINT) AS total_pii_detected,
                          CAST(count_if(ns + nn > 0) AS BIGINT) AS payloads_with_pii,
                          'success' AS status, CAST(0 AS BIGINT) AS failed_rows
                   FROM pk GROUP BY {file_id}"""
    out["json_file_job"] = with_views(file_rows, pf, candidates_ctes("pf"), kept_ctes(),
                                      per_payload)
    out["redact_stream"] = out["json_file_job"]
    out["payload_stats"] = with_views(
        """SELECT CAST(verbatim_id AS VARCHAR) AS payload_id,
                  CAST(ns + nn AS INTEGER) AS pii_detected,
                  concat_ws(',', CASE WHEN ns > 0 THEN 'sentence' END,
                                 CASE WHEN nn > 0 THEN 'notes' END) AS fields_with_pii,
                  'success' AS status
           FROM pk""",
        pf, candidates_ctes("pf"), kept_ctes(), per_payload)
    kind = f"(file_id // 100000) % {MIXED_KINDS}"
    out["json_file_outcomes"] = f"""
WITH r AS ({out["payload_redaction"]}),
f AS (SELECT *, (verbatim_id // 1000000) // {CONVERSATIONS_PER_FILE} * 100000
             + (verbatim_id % 1000000) // {TURNS_PER_FILE} AS file_id FROM r)
SELECT CAST(file_id AS BIGINT) AS file_id, 'success' AS status, '' AS error, verbatim_id, sentence, notes
FROM f WHERE {kind} < 3
UNION ALL
SELECT DISTINCT CAST(file_id AS BIGINT), 'failed', 'Invalid JSON format', CAST(NULL AS BIGINT),
       CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM f WHERE {kind} >= 3"""
    kind = f"(file_id // 100000) % {MIXED_KINDS}"
    strategies = ",".join(available_strategies())
    out["json_file_job_results"] = f"""
SELECT file_id, CASE WHEN ok THEN 'success' ELSE 'failed' END AS status, ok AS has_dest,
       CASE WHEN ok THEN total_payloads ELSE 0 END AS processed_payloads, CAST(0 AS BIGINT) AS failed_payloads,
       CASE WHEN ok THEN total_pii_detected ELSE 0 END AS total_pii_redacted, CAST(0 AS INTEGER) AS n_warnings,
       true AS regex_available, false AS comprehend_available, true AS cer_endpoint, 'regex,cer' AS detection_methods,
       'mask' AS current_strategy, '{strategies}' AS available_strategies, 'mask' AS strategy_function, true AS times_in_order
FROM (SELECT *, {kind} < 3 AS ok FROM ({out["json_file_job"]}))"""
    out["restarted_file_job"] = f"SELECT file_id, status, verbatim_id FROM ({out['json_file_outcomes']})"
    out.update(report_queries())
    out["hash_labels_over_runs"] = out["hash_canonical_labels"]
    out.update(feedback_queries())
    return out


def _pats(types):
    return [p for p in CATALOGUE if p.entity_type in types]


PK_CTE = """
pk AS (SELECT c.src, c.key, c.source_file, c.text, kept.k, coalesce(len(kept.k), 0) AS n
       FROM corpus c LEFT JOIN kept ON c.src = kept.src AND c.key = kept.key)"""

JOB_ROWS_CTE = """
jobs AS (
  SELECT source_file, CAST(count(*) AS BIGINT) AS total_payloads,
         CAST(count(*) AS BIGINT) AS processed_payloads, CAST(0 AS BIGINT) AS failed_payloads,
         CAST(sum(n) AS BIGINT) AS total_pii_detected, CAST(sum(n) AS BIGINT) AS total_pii_redacted,
         CAST(count_if(n > 0) AS BIGINT) AS payloads_with_pii, 'success' AS status,
         CAST(0 AS BIGINT) AS failed_rows,
         CAST(sum(n) AS DOUBLE) / count(*) AS pii_rate
  FROM pk GROUP BY source_file)"""

VALIDATION_MSG = "'PII text ''' || x.t || ''' still present in redacted text'"


def report_queries() -> dict:
    base = (candidates_ctes("corpus"), kept_ctes(), PK_CTE)
    out = {}
    rl = """
ents AS (SELECT src, key, unnest(k) AS x FROM kept),
labels AS (SELECT x.t AS t, first(x.y ORDER BY src, key, x.s DESC) AS lab FROM ents GROUP BY x.t),
rl AS (SELECT e.src, e.key, list({'s': e.x.s, 'e': e.x.e, 't': e.x.t, 'y': l.lab} ORDER BY e.x.s) AS k
       FROM ents e JOIN labels l ON e.x.t = l.t GROUP BY e.src, e.key)"""
    out["hash_canonical_labels"] = with_views(
        f"""SELECT c.src, c.key, coalesce({splice_sql('c.text', 'rl.k', 'hash')}, c.text)
                   AS redacted_text, CAST(coalesce(len(rl.k), 0) AS INTEGER) AS n_redacted
            FROM corpus c LEFT JOIN rl ON c.src = rl.src AND c.key = rl.key""",
        candidates_ctes("corpus"), kept_ctes(), rl)
    out["job_stats_by_source"] = with_views("SELECT * FROM jobs", *base, JOB_ROWS_CTE)
    out["batch_summary"] = with_views(
        """SELECT CAST(count(*) AS BIGINT) AS files_total,
                  CAST(count_if(status = 'success') AS BIGINT) AS files_success,
                  CAST(count_if(status <> 'success') AS BIGINT) AS files_failed,
                  CAST(coalesce(sum(CASE WHEN status = 'success' THEN processed_payloads END), 0)
                       AS BIGINT) AS total_payloads,
                  CAST(coalesce(sum(CASE WHEN status = 'success' THEN total_pii_detected END), 0)
                       AS BIGINT) AS total_pii
           FROM jobs""", *base, JOB_ROWS_CTE)
    out["detection_report"] = with_views(
        """SELECT CAST(count(*) AS BIGINT) AS total_payloads,
                  CAST(count_if(n > 0) AS BIGINT) AS payloads_with_pii,
                  CAST(count(*) - count_if(n > 0) AS BIGINT) AS clean_payloads,
                  CAST(sum(n) AS BIGINT) AS total_entities,
                  CAST(sum(n) AS DOUBLE) / count(*) AS avg_per_payload,
                  CAST(100.0 AS DOUBLE) * count_if(n > 0) / count(*) AS pct_with_pii
           FROM pk""", *base)
    out["job_summary"] = with_views(
        """SELECT status, source_file AS file, processed_payloads AS payloads_processed,
                  total_pii_detected AS pii_detected, total_pii_redacted AS pii_redacted,
                  coalesce(CAST(total_pii_detected AS DOUBLE) / total_payloads, 0.0) AS pii_rate
           FROM jobs""", *base, JOB_ROWS_CTE)
    out["text_preview"] = with_views(
        """SELECT src, key,
                  CASE WHEN length(text) > 60 THEN substring(text, 1, 60) || '...' ELSE text END
                    AS preview,
                  CAST(n AS INTEGER) AS n_entities
           FROM pk WHERE n > 0""", *base)
    out["entity_type_histogram"] = with_views(
        "SELECT x.y AS entity_type, CAST(count(*) AS BIGINT) AS n "
        "FROM (SELECT unnest(k) AS x FROM kept) GROUP BY x.y", candidates_ctes("corpus"),
        kept_ctes())
    out["validation_report"] = with_views(
        f"""SELECT src, key, len(errs) = 0 AS is_valid, CAST(len(errs) AS INTEGER) AS n_errors,
                   CAST(CASE WHEN length(r) > length(text) * 1.5 THEN 1 ELSE 0 END AS INTEGER)
                     AS n_warnings,
                   array_to_string(errs, ' | ') AS errors,
                   CASE WHEN length(r) > length(text) * 1.5 THEN
                     'Redacted text significantly longer than original (' || length(r) || ' vs '
                     || length(text) || ' chars)' ELSE '' END AS warnings
            FROM (SELECT src, key, text, r,
                         list_transform(list_filter(list_reverse(k),
                                        lambda x: contains(lower(r), lower(x.t))),
                                        lambda x: {VALIDATION_MSG}) AS errs
                  FROM (SELECT src, key, text, k,
                               {splice_sql('text', 'k', 'placeholder')} AS r
                        FROM pk WHERE n > 0))""", *base)
    out["payloads_with_given_entities"] = with_views(
        """SELECT verbatim_id,
                  CASE WHEN ok AND s THEN '[REDACTED]' || substring(sentence, 6) ELSE sentence END AS sentence,
                  CASE WHEN ok AND n THEN substring(notes, 1, 11) || '[REDACTED_PERSON]' || substring(notes, 22)
                       ELSE notes END AS notes,
                  CAST(CASE WHEN ok THEN CAST(s AS INTEGER) + CAST(n AS INTEGER) ELSE 0 END AS INTEGER) AS redaction_count,
                  CASE WHEN ok THEN 'success' ELSE 'failed' END AS status
           FROM (SELECT p.verbatim_id, p.sentence, p.notes,
                        count_if(g.field_name = 'sentence') > 0 AS s, count_if(g.field_name = 'notes') > 0 AS n,
                        count_if(g.begin_offset IS NULL OR g.begin_offset < 0) = 0 AS ok
                 FROM payloads p JOIN given g ON p.verbatim_id = g.verbatim_id
                 GROUP BY p.verbatim_id, p.sentence, p.notes)""",
        f"given AS ({GIVEN_SQL})")
    few = "SELECT * FROM payloads WHERE ordinal % 4 <> 1"
    out["payloads_paired_by_position"] = with_views(
        " UNION ALL ".join(
            f"""SELECT '{case}' AS "case", a.verbatim_id,
                  CASE WHEN hit AND s <> '' THEN '[REDACTED]' || substring(s, 6) ELSE s END AS sentence,
                  CASE WHEN hit AND n <> '' THEN substring(n, 1, 11) || '[REDACTED_PERSON]' || substring(n, 22) ELSE n END AS notes,
                  CAST(CASE WHEN hit THEN CAST(coalesce(trim(s) <> '', false) AS INTEGER)
                                        + CAST(coalesce(trim(n) <> '', false) AS INTEGER) ELSE 0 END AS INTEGER) AS pii_detected
                FROM (SELECT verbatim_id, sentence AS s, notes AS n, row_number() OVER (ORDER BY verbatim_id) AS i FROM ({left})) a
                JOIN (SELECT verbatim_id % 3 <> 0 AS hit, row_number() OVER (ORDER BY verbatim_id) AS i FROM ({right})) USING (i)"""
            for case, left, right in (("more payloads", "SELECT * FROM payloads", few), ("more results", few, "SELECT * FROM payloads"))))
    return out


FIRST_PASS_TYPES = ("EMAIL", "PHONE", "ZIP_CODE", "ADDRESS", "CREDIT_CARD")
RESIDUAL_TYPES = ("EMAIL", "PHONE", "SSN", "CREDIT_CARD", "NAME")


def _spans_sql(k: str) -> str:
    rep_y = strategy_sql("placeholder", "y.t", "y.y")
    rep_i = strategy_sql("placeholder", f"{k}[i].t", f"{k}[i].y")
    shift = (f"coalesce(list_sum(list_transform({k}[1:i - 1], lambda y: length({rep_y}) "
             f"- (y.e - y.s))), 0)")
    return (f"list_transform(range(1, len({k}) + 1), lambda i: {{'s': {k}[i].s + {shift}, "
            f"'e': {k}[i].s + {shift} + length({rep_i})}})")


def _feedback_ctes() -> tuple:
    fp = f"""
fp AS (
  SELECT c.src, c.key, c.source_file, c.text, k1.k AS k,
         coalesce({splice_sql('c.text', 'k1.k', 'placeholder')}, c.text) AS redacted,
         CASE WHEN k1.k IS NULL THEN NULL ELSE {_spans_sql('k1.k')} END AS spans
  FROM corpus c LEFT JOIN k1 ON c.src = k1.src AND c.key = k1.key),
red AS (SELECT src, key, redacted AS text FROM fp)"""
    leaks = """
leaks AS (
  SELECT fp.src, fp.key, fp.source_file, l.x
  FROM (SELECT src, key, unnest(k) AS x FROM k2) l JOIN fp ON l.src = fp.src AND l.key = fp.key
  WHERE CASE WHEN fp.spans IS NULL THEN true
             ELSE len(list_filter(fp.spans, lambda s: l.x.s < s.e AND l.x.e > s.s)) = 0 END)"""
    quar = """
qfiles AS (SELECT DISTINCT source_file FROM leaks),
quar AS (SELECT * FROM corpus WHERE source_file IN (SELECT source_file FROM qfiles))"""
    ex = """
red1 AS (SELECT src, key, unnest(k) AS x FROM k1),
ex AS (
  SELECT q.src, q.key, q.source_file,
         substring(q.text, f.begin_offset + 1, f.end_offset - f.begin_offset) AS text,
         f.begin_offset, f.end_offset, f.type, f.source
  FROM quar q JOIN findings f ON q.src = f.src AND q.key = f.key
  WHERE NOT EXISTS (SELECT 1 FROM red1 r WHERE r.src = q.src AND r.key = q.key
                    AND f.begin_offset < r.x.e AND f.end_offset > r.x.s)),
exu AS (
  SELECT src, key, source_file, text, type, source, begin_offset AS start_pos FROM ex
  UNION ALL
  SELECT src, key, source_file, x.t AS text, x.y AS type, 'RESIDUAL' AS source, x.s AS start_pos
  FROM leaks)"""
    return (candidates_ctes("corpus", _pats(FIRST_PASS_TYPES), name="c1"), kept_ctes("c1", "k1"),
            fp, candidates_ctes("red", _pats(RESIDUAL_TYPES), name="c2"),
            kept_ctes("c2", "k2"), leaks, quar, ex)


def feedback_queries() -> dict:
    ctes = _feedback_ctes()
    out = {}
    out["residual_leaks"] = with_views(
        "SELECT src, key, source_file, x.y AS entity_type, x.s AS start_pos, x.e AS end_pos, "
        "x.t AS text FROM leaks", *ctes)
    out["quarantine_semi"] = with_views("SELECT src, key, source_file FROM quar", *ctes)
    out["clean_anti"] = with_views(
        "SELECT src, key, source_file FROM corpus c WHERE NOT EXISTS "
        "(SELECT 1 FROM qfiles q WHERE q.source_file = c.source_file)", *ctes)
    out["training_examples"] = with_views(
        "SELECT src, key, source_file, text, begin_offset, end_offset, type, source FROM ex",
        *ctes)
    out["training_dedup"] = with_views(
        "SELECT text, type, CAST(count(*) AS BIGINT) AS n_examples, "
        "min(source_file) AS first_source_file FROM exu GROUP BY text, type", *ctes)
    out["training_set_over_runs"] = with_views("SELECT DISTINCT text, type FROM exu", *ctes)
    out["leak_alerts"] = with_views(
        "SELECT source_file, x.y AS entity_type, CAST(count(*) AS BIGINT) AS n_leaks "
        "FROM leaks GROUP BY source_file, x.y", *ctes)
    out["quarantine_scan"] = with_views(
        """SELECT q.src, q.key, q.source_file, x.y AS entity_type, x.s AS start_pos,
                  x.e AS end_pos, x.t AS text, x.o AS source
           FROM (SELECT src, key, unnest(k) AS x FROM kq) u
           JOIN quar q ON q.src = u.src AND q.key = u.key""",
        *ctes, candidates_ctes("quar", name="cq"), FINDING_ENTITIES_CTE,
        """allq AS (SELECT * FROM cq UNION ALL BY NAME
                   SELECT * FROM fent f WHERE EXISTS (SELECT 1 FROM quar q
                                                      WHERE q.src = f.src AND q.key = f.key))""",
        kept_ctes("allq", "kq"))
    out["review_sample"] = with_views(
        """SELECT type, text, src, key, CAST(rn AS INTEGER) AS sample_rank FROM (
             SELECT *, row_number() OVER (PARTITION BY type ORDER BY
               md5(concat_ws('|', text, src, CAST(key AS VARCHAR), CAST(start_pos AS VARCHAR),
                             source)), text, src, key, start_pos, source) AS rn
             FROM exu) WHERE rn <= 3""", *ctes)
    return out
