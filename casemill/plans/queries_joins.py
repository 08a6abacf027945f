"""Registered queries: joins, exposure, grading, curation, embeddings, streams."""

import os
import re
import uuid

from pyspark.sql import functions as F

from casemill import fixed
from casemill.functions import embed as E
from casemill.functions import scalars as S
from casemill.operators import grade as G
from casemill.operators import joins as J
from casemill.operators import metrics as M
from casemill.operators import workspace as W
from casemill.operators.curate import curate
from casemill.operators.neighbors import nearest_distance
from casemill.plans import adapters as A
from casemill.plans import reports
from casemill.plans.sql import ORDER_LINES, SCANS, STAGES, VERDICTS
from casemill.session import ensure_checkpoint_dir
from casemill.sources.headlines import headline_rows, parse_headlines, render_headlines
from casemill.streaming import streams

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    def keep(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return keep


def _id(prefix, col):
    return F.concat(F.lit(prefix), F.col(col).cast("string"))


# ------------------------------------------------------------------ stages and stories


@query(
    "first_seen",
    f"""WITH {STAGES}, c AS (SELECT DISTINCT 'cand-' || user_id AS id FROM events UNION ALL SELECT 'art-' || event_id FROM events WHERE event_type = 'signup')
    SELECT id, coalesce((SELECT min(ts) FROM (SELECT artifact_id AS ref, wallclock_ts AS ts FROM stages
      UNION ALL SELECT parent_artifact_id, wallclock_ts FROM stages) r WHERE r.ref = c.id), '') AS first_seen FROM c""",
)
def first_seen(spark, sf):
    e = A.table(spark, sf, "events")
    ids = e.select(_id("cand-", "user_id").alias("id")).distinct().unionByName(
        e.where(F.col("event_type") == "signup").select(_id("art-", "event_id").alias("id"))
    )
    return J.first_seen(ids, A.stage_records(spark, sf))


def _attempts(spark, sf):
    """Turns of a conversation as attempts at one design: the last assistant turn of some is accepted."""
    c = A.table(spark, sf, "conversations")
    row = c.select(
        F.when(F.col("conv_id") % 9 != 0, _id("design-", "conv_id")).alias("design_id"),
        F.concat(F.lit("cand-"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("id"),
        F.col("role").alias("case_type"), F.lit("skill").alias("ability"), F.col("text").alias("prompt"), F.lit("").alias("proxy_claim"),
        (F.col("conv_id") * 100 + F.col("turn")).alias("ord"),
        ((F.col("turn") == 3) & (F.col("conv_id") % 2 == 0)).alias("ok"),
        A.choose(F.col("turn") % 3, {0: "reject_schema", 1: "reject_leakage"}, "drop_retry_exhausted").alias("route_code"),
        F.array(F.lit("code")).alias("subcodes"),
    )
    return row.where(~F.col("ok")).drop("ok"), row.where("ok").drop("ok", "route_code", "subcodes")


@query(
    "design_stories",
    """WITH a AS (SELECT CASE WHEN conv_id % 9 <> 0 THEN 'design-' || conv_id ELSE 'unknown-design' END AS design_id,
      'cand-' || conv_id || '-' || turn AS id, turn, role, text, turn = 3 AND conv_id % 2 = 0 AS ok,
      CASE WHEN turn = 3 AND conv_id % 2 = 0 THEN 'accept' WHEN turn % 3 = 0 THEN 'reject_schema' WHEN turn % 3 = 1 THEN 'reject_leakage'
        ELSE 'drop_retry_exhausted' END AS route FROM conversations),
    g AS (SELECT design_id, count(*) AS attempts, count(*) FILTER (ok) AS n_ok, arg_max(route, id) AS final_route,
      arg_min(role, id) AS case_type, arg_min(text, id) AS text FROM a GROUP BY 1),
    f AS (SELECT *, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS flat FROM g)
    SELECT design_id, CASE WHEN n_ok > 0 THEN 'accepted' ELSE 'failed' END AS final_status, attempts, case_type, 'skill' AS ability,
      CASE WHEN length(flat) <= 220 THEN flat ELSE left(flat, 219) || '...' END AS prompt, final_route,
      starts_with(final_route, 'drop_') AS dropped FROM f""",
)
def design_stories(spark, sf):
    rejected, accepted = _attempts(spark, sf)
    stories = reports.design_stories(rejected, accepted, A.stage_records(spark, sf))
    return stories.drop("first_seen", "proxy_claim")


@query(
    "story_lines",
    """WITH a AS (SELECT CASE WHEN conv_id % 9 <> 0 THEN 'design-' || conv_id ELSE 'unknown-design' END AS design_id,
      'cand-' || conv_id || '-' || turn AS id, turn, turn = 3 AND conv_id % 2 = 0 AS ok,
      CASE WHEN turn = 3 AND conv_id % 2 = 0 THEN 'accept' WHEN turn % 3 = 0 THEN 'reject_schema' WHEN turn % 3 = 1 THEN 'reject_leakage'
        ELSE 'drop_retry_exhausted' END AS route FROM conversations)
    SELECT design_id, row_number() OVER (PARTITION BY design_id ORDER BY id) AS position, turn AS attempt,
      'attempt ' || turn || ': ' || CASE WHEN ok THEN 'accepted' ELSE 'rejected' END || ' route=' || route || ' codes='
        || CASE WHEN ok THEN '-' ELSE 'code' END AS line FROM a""",
)
def story_lines(spark, sf):
    return reports.story_lines(*_attempts(spark, sf)).drop("gates")


@query(
    "attempt_sequence",
    """SELECT 'cand-' || conv_id || '-' || turn AS id, row_number() OVER (PARTITION BY conv_id ORDER BY 'cand-' || conv_id || '-' || turn) AS position,
      turn = max(turn) OVER (PARTITION BY conv_id) AS is_final FROM conversations""",
)
def attempt_sequence(spark, sf):
    c = A.table(spark, sf, "conversations").select(
        _id("design-", "conv_id").alias("design_id"),
        F.concat(F.lit("cand-"), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")).alias("id"),
    )
    return M.sequence_attempts(c).select("id", "position", "is_final")


@query(
    "latest_revisions",
    """SELECT 'design-' || conv_id AS design_id, 'cand-' || conv_id || '-' || max(turn) AS candidate_id, max(turn) // 2 AS retry_index
    FROM conversations GROUP BY conv_id""",
)
def latest_revisions(spark, sf):
    c = A.table(spark, sf, "conversations")
    ident = lambda turn: F.concat(F.lit("cand-"), F.col("conv_id").cast("string"), F.lit("-"), turn.cast("string"))
    snapshots = c.select(
        _id("design-", "conv_id").alias("design_id"),
        ident(F.col("turn")).alias("candidate_id"),
        F.when(F.col("turn") % 2 == 1, ident(F.col("turn") - 1)).alias("parent_candidate_id"),
        F.when(F.col("turn") % 2 == 1, F.lit("adversary_revision")).otherwise(F.lit("generation")).alias("phase"),
        F.floor(F.col("turn") / 2).alias("retry_index"),
    )
    return M.latest_revision(snapshots).drop("phase")


# ------------------------------------------------------------------ exposure

_PRODUCTS = """products AS (SELECT DISTINCT request_id, product_id FROM (SELECT request_id, product_id FROM requests JOIN links USING (entity_id)
  UNION ALL SELECT request_id, entity_id FROM requests)),"""


@query(
    "supplier_exposure",
    f"""WITH {ORDER_LINES}, requests AS (SELECT s_name AS request_id, 'S-' || s_suppkey AS entity_id FROM supplier), {_PRODUCTS}
    hit AS (SELECT request_id, o.* , coalesce(stock, 0) < quantity AS tight FROM products JOIN order_lines o USING (product_id)
      LEFT JOIN stock USING (product_id) WHERE is_open),
    sums AS (SELECT request_id, count(*) AS open_orders, sum(quantity * unit_revenue) AS revenue, bool_or(tight) AS tight FROM hit GROUP BY 1)
    SELECT request_id, count(*) AS products, CAST(coalesce(any_value(open_orders), 0) AS BIGINT) AS open_orders,
      CAST(coalesce(any_value(revenue), 0) AS BIGINT) AS revenue_at_risk, coalesce(any_value(tight), false) AS constrained_inventory
    FROM products LEFT JOIN sums USING (request_id) GROUP BY request_id""",
)
def supplier_exposure(spark, sf):
    """What every supplier's failure would put at risk."""
    return J.calculate_exposure(
        A.supplier_requests(spark, sf), A.bom_links(spark, sf), A.order_lines(spark, sf), A.inventory(spark, sf)
    )


@query(
    "region_customers",
    f"""WITH {ORDER_LINES}, requests AS (SELECT r_name AS request_id, 'S-' || s_suppkey AS entity_id FROM supplier
      JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey), {_PRODUCTS}
    hit AS (SELECT DISTINCT request_id, customer FROM products JOIN order_lines USING (product_id) WHERE is_open) SELECT * FROM hit""",
)
def region_customers(spark, sf):
    """Customers a failure of all of a region's suppliers would reach."""
    return J.exposed_customers(A.region_requests(spark, sf), A.bom_links(spark, sf), A.order_lines(spark, sf))


# ------------------------------------------------------------------ gates and lookups


@query(
    "gate_join",
    f"""WITH {VERDICTS}, q AS (SELECT * FROM verdicts WHERE check_kind = 'quality'), r AS (SELECT * FROM verdicts WHERE check_kind = 'rubric'),
    j AS (SELECT q.candidate_id, coalesce(CASE WHEN q.route_code = 'retry_infra' THEN 'retry_infra' END,
        CASE WHEN r.route_code = 'retry_infra' THEN 'retry_infra' END) AS provider,
      CASE WHEN q.verdict = 'reject' THEN list_prepend('quality_gate_rejected', q.subcodes) ELSE CAST([] AS VARCHAR[]) END AS a,
      CASE WHEN r.verdict = 'reject' THEN list_prepend('rubric_gate_rejected', r.subcodes) ELSE CAST([] AS VARCHAR[]) END AS b
      FROM q JOIN r USING (candidate_id))
    SELECT candidate_id, CASE WHEN provider IS NULL THEN 'accept' ELSE 'reject' END AS verdict, coalesce(provider, 'accept') AS route_code,
      array_to_string(list_concat(a, list_filter(b, lambda c: NOT list_contains(a, c))), ',') AS subcodes FROM j""",
)
def gate_join(spark, sf):
    v = A.verdicts(spark, sf)
    joined = J.join_gates(v.where(F.col("check_kind") == "quality"), v.where(F.col("check_kind") == "rubric"))
    return joined.withColumn("subcodes", F.array_join("subcodes", ","))


@query(
    "audit_views",
    """WITH v AS (SELECT c_custkey AS vendor, c_mktsegment AS view, c_custkey % 4 = 3 AS foreign_owner, c_acctbal FROM customer),
    r AS (SELECT o_orderkey, o_custkey, v.*, CASE WHEN v.vendor IS NULL THEN 'unknown_view' WHEN foreign_owner THEN 'vendor_mismatch' ELSE 'result' END AS status
      FROM orders LEFT JOIN v ON o_custkey = vendor AND view = CASE o_orderkey % 2 WHEN 0 THEN 'BUILDING' ELSE 'MACHINERY' END)
    SELECT 'SO-' || o_orderkey AS request_id, status, CASE WHEN status = 'result' AND vendor % 4 <> 2 THEN 'V-' || vendor END AS owner,
      CASE WHEN status = 'result' THEN CAST(r.c_acctbal AS DOUBLE) END AS balance, CASE WHEN status = 'unknown_view' THEN coalesce(c_mktsegment, '') END AS available
    FROM r LEFT JOIN customer c ON c.c_custkey = o_custkey""",
)
def audit_views(spark, sf):
    c, o = A.table(spark, sf, "customer"), A.table(spark, sf, "orders")
    owner = F.when(F.col("c_custkey") % 4 == 3, F.lit("V-other")).when(F.col("c_custkey") % 4 != 2, _id("V-", "c_custkey"))
    views = c.select(
        _id("V-", "c_custkey").alias("vendor_id"), F.col("c_mktsegment").alias("view"),
        F.to_json(F.struct(owner.alias("vendor_id"), F.col("c_acctbal").alias("balance"))).alias("result"),
    )
    view = F.when(F.col("o_orderkey") % 2 == 0, F.lit("BUILDING")).otherwise(F.lit("MACHINERY"))
    requests = o.select(_id("SO-", "o_orderkey").alias("request_id"), _id("V-", "o_custkey").alias("vendor_id"), view.alias("view"))
    out = J.audit_view(requests, views)
    read = lambda key: F.get_json_object("result", f"$.{key}")
    return out.select(
        "request_id", "status", read("vendor_id").alias("owner"), read("balance").cast("double").alias("balance"), F.array_join("available_views", ",").alias("available")
    )


def _said(code):
    """The advice on a code as an SQL string."""
    return "'" + fixed.GENERATOR_GUIDANCE[code].replace("'", "''") + "'"


@query(
    "retry_guidance",
    f"""WITH {STAGES}, c AS (SELECT ord, list_distinct([coalesce(code, 'weak_proxy_validity'), CASE WHEN ord % 3 = 0 THEN 'missing_oracle' ELSE 'weak_diagnostic_pressure' END]) AS codes,
      code, ord % 3 = 0 AS o FROM stages)
    SELECT ord, coalesce(code, 'weak_proxy_validity') || ',' || CASE WHEN o THEN 'weak_judge_confidence' ELSE 'weak_diagnostic_pressure' END AS safe,
      concat_ws(chr(10), CASE WHEN code IS NULL THEN {_said('weak_proxy_validity')} END, CASE WHEN NOT o THEN {_said('weak_diagnostic_pressure')} END) AS advice
    FROM c""",
)
def retry_guidance(spark, sf):
    s = A.stage_records(spark, sf)
    second = F.when(F.col("ord") % 3 == 0, F.lit("missing_oracle")).otherwise(F.lit("weak_diagnostic_pressure"))
    first = F.coalesce(F.get("subcodes", F.lit(0)), F.lit("weak_proxy_validity"))
    out = J.retry_guidance(s.select("ord", F.array(first, second, second).alias("subcodes")))
    return out.select("ord", F.array_join("safe_subcodes", ",").alias("safe"), F.array_join("guidance", "\n").alias("advice"))


# ------------------------------------------------------------------ trials


def _trials(spark, sf):
    o = A.table(spark, sf, "orders")
    return o.select(
        F.col("o_orderkey").alias("trial"), _id("case-", "o_custkey").alias("case_id"),
        F.when(F.col("o_orderkey") % 2 == 0, F.lit("baseline")).otherwise(F.lit("evidence_first")).alias("variant"),
        (F.col("o_orderstatus") == "F").alias("passed"), F.col("o_totalprice").alias("score"),
        F.col("o_orderpriority").alias("label"),
    )


@query(
    "paired_variants",
    """WITH t AS (SELECT o_custkey, o_orderkey % 2 = 0 AS base, arg_max(o_orderstatus, o_orderkey) AS s, arg_max(o_totalprice, o_orderkey) AS p,
      arg_max(o_orderpriority, o_orderkey) AS l, max(o_orderkey) AS k FROM orders GROUP BY ALL)
    SELECT 'case-' || b.o_custkey AS case_id, b.k AS baseline_trial, b.s = 'F' AS baseline_passed, b.p AS baseline_score, b.l AS baseline_label,
      e.k AS evidence_first_trial, e.s = 'F' AS evidence_first_passed, e.p AS evidence_first_score, e.l AS evidence_first_label, b.l <> e.l AS diverges
    FROM t b JOIN t e ON b.o_custkey = e.o_custkey AND b.base AND NOT e.base""",
)
def paired_variants(spark, sf):
    return J.paired_variants(_trials(spark, sf))


@query(
    "missing_trials",
    """WITH m AS (SELECT c_custkey, variant, r, s FROM customer, (VALUES ('baseline'), ('evidence_first')) v(variant),
      (VALUES (1), (2)) x(r), (VALUES (7)) y(s))
    SELECT 'case-' || c_custkey AS case_id, variant, CAST(r AS INT) AS repeat, CAST(s AS INT) AS seed FROM m WHERE NOT EXISTS (SELECT 1 FROM orders
      WHERE o_custkey = c_custkey AND (o_orderkey % 2 = 0) = (variant = 'baseline'))""",
)
def missing_trials(spark, sf):
    cases = A.table(spark, sf, "customer").select(_id("case-", "c_custkey").alias("case_id"))
    matrix = J.trial_matrix(cases, ["baseline", "evidence_first"], repeats=2, seeds=[7])
    return J.missing_trials(matrix, _trials(spark, sf).select("case_id", "variant").distinct())


@query(
    "experiment_metrics",
    """SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'baseline' ELSE 'evidence_first' END AS variant, count(*) AS trials,
      round(avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END)::DOUBLE, 6) AS pass_rate, round(avg((o_orderkey % 100) / 100.0)::DOUBLE, 6) AS score,
      round(avg(o_orderkey % 3)::DOUBLE, 6) AS false_positive_count FROM orders GROUP BY ALL""",
)
def experiment_metrics(spark, sf):
    o = A.table(spark, sf, "orders")
    grade = F.struct(
        (F.col("o_orderstatus") == "F").alias("passed"), ((F.col("o_orderkey") % 100) / 100).alias("score"),
        (F.col("o_orderkey") % 3).alias("false_positive_count"),
    )
    variant = F.when(F.col("o_orderkey") % 2 == 0, F.lit("baseline")).otherwise(F.lit("evidence_first"))
    out = M.experiment_metrics(o.select(variant.alias("variant"), F.to_json(grade).alias("grade")))
    return out.select("variant", "trials", *[F.round(c, 6).alias(c) for c in ("pass_rate", "score", "false_positive_count")])


@query(
    "experiment_comparison",
    """WITH g AS (SELECT 'v' || (o_orderkey % 3) AS variant, o_orderstatus = 'F' AS passed, (o_orderkey % 100) / 100.0 AS score,
      CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey % 7 END AS fps, o_totalprice AS cost FROM orders),
    m AS (SELECT variant, count(*) AS trials, avg(passed::INT) AS passed, avg(score)::DOUBLE AS score, avg(fps) AS fps, avg(cost) AS cost FROM g GROUP BY 1),
    l AS (SELECT variant, trials, unnest(['pass_rate', 'score', 'false_positives', 'cost', 'absent']) AS metric,
      unnest([1, 1, -1, -1, 1]) AS sign, unnest([passed, score, fps, cost, NULL]) AS value FROM m)
    SELECT l.metric, l.variant, round(l.value, 6) AS value, round(b.value, 6) AS baseline_value,
      CASE WHEN l.value IS NULL THEN 'unknown' WHEN l.sign * (l.value - b.value) > 0 THEN 'better' WHEN l.value = b.value THEN 'equal' ELSE 'worse' END AS outcome
    FROM l JOIN l b ON b.metric = l.metric AND b.variant = 'v0' WHERE l.variant <> 'v0'""",
)
def experiment_comparison(spark, sf):
    """Metrics named by pointers into nested grades: escaped names, array positions, names of digits, absent ones."""
    key = F.col("o_orderkey")
    grade = F.struct(
        F.struct((F.col("o_orderstatus") == "F").alias("pass/fail"), (key % 100 / 100).cast("string").alias("a~b")).alias("payload"),
        F.array(F.struct(F.lit(0).alias("x")), F.struct(F.when(key % 5 != 0, key % 7).alias("x"))).alias("checks"),
        F.struct(F.col("o_totalprice").alias("0")).alias("cost"),
    )
    definitions = spark.createDataFrame(
        [
            ("pass_rate", "/payload/pass~1fail", "higher"), ("score", "/payload/a~0b", "higher"), ("false_positives", "/checks/1/x", "lower"),
            ("cost", "/cost/0", "lower"), ("absent", "/checks/7/x", "higher"),
        ],
        "metric string, pointer string, direction string",
    )
    grades = A.table(spark, sf, "orders").select(F.concat(F.lit("v"), (key % 3).cast("string")).alias("variant"), F.to_json(grade).alias("grade"))
    out = M.compare_variants(M.pointer_metrics(grades, definitions), "v0")
    return out.select("metric", "variant", F.round("value", 6).alias("value"), F.round("baseline_value", 6).alias("baseline_value"), "outcome")


# ------------------------------------------------------------------ grading


@query("scan_validity", f"WITH {SCANS} SELECT case_id, valid AS schema_valid FROM n")
def scan_validity(spark, sf):
    return G.parse_scans(A.raw_scans(spark, sf)).select("case_id", "schema_valid")


@query(
    "alert_matches",
    f"""WITH {SCANS}, m AS (SELECT *, CASE WHEN alerts = 0 THEN 0 WHEN style = 6 THEN 4 WHEN style = 1 THEN 5 ELSE 6 END AS s FROM n WHERE NOT zero AND valid)
    SELECT case_id, 'A-' || substr(case_id, 4) AS expected_alert_id, CASE WHEN alerts = 0 THEN 'none' ELSE 'a1' END AS submitted_alert_id,
      s >= 4 AS matched, CAST(s AS INT) AS match_score FROM m""",
)
def alert_matches(spark, sf):
    scans = G.parse_scans(A.raw_scans(spark, sf))
    best = G.best_alert_match(scans, A.scan_oracles(spark, sf))
    return best.drop("checks").fillna("none", ["submitted_alert_id"])


@query(
    "alert_false_positives",
    f"""WITH {SCANS} SELECT case_id, unnest(CASE WHEN style = 3 AND zero THEN ['a2', 'a1'] WHEN style = 3 THEN ['a2']
      ELSE CAST([] AS VARCHAR[]) END) AS alert_id FROM n WHERE valid""",
)
def alert_false_positives(spark, sf):
    return G.false_positives(G.parse_scans(A.raw_scans(spark, sf)), A.scan_oracles(spark, sf))


_GRADES = f"""WITH {SCANS}, c AS (SELECT *,
  valid AND (CASE WHEN zero THEN silent ELSE NOT silent END) AS result_correct,
  valid AND (CASE WHEN zero THEN alerts = 0 ELSE alerts > 0 END) AS hit,
  valid AND (CASE WHEN zero THEN alerts = 0 ELSE alerts > 0 AND style <> 6 END) AS latent,
  valid AND (CASE WHEN zero THEN alerts = 0 ELSE alerts > 0 AND style <> 1 END) AS exposure,
  valid AND (CASE WHEN zero THEN silent ELSE alerts > 0 END) AS cited,
  valid AND (CASE WHEN zero THEN silent ELSE alerts > 0 AND style <> 6 END) AS hedged,
  CASE WHEN NOT valid THEN 0 WHEN zero THEN alerts WHEN style = 3 THEN 1 ELSE 0 END AS fp,
  valid AND style = 4 AND alerts > 0 AS invented FROM n),
p AS (SELECT *, (20 * result_correct::INT + 10 * hit::INT + 20 * latent::INT + 20 * hit::INT + 15 * exposure::INT + 10 * cited::INT + 5 * hedged::INT
  - 20 * fp) / 100.0 AS raw FROM c),
s AS (SELECT *, CASE WHEN NOT valid OR invented THEN 0.0 ELSE greatest(0.0, raw) END AS score FROM p) """


@query(
    "scan_grades",
    _GRADES
    + """SELECT case_id, score >= 0.85 AND exposure AND fp = 0 AND NOT invented AND valid AS passed, round(score::DOUBLE, 4) AS score,
      result_correct, hit AS source_headline, latent AS latent_edge, hit AS enterprise_path, exposure AS business_exposure, cited AS citations,
      hedged AS calibrated_uncertainty, CAST(fp AS INT) AS false_positive_count, invented AS invented_company_record, NOT valid AS schema_violation FROM s""",
)
def scan_grades(spark, sf):
    graded = G.grade_scans(G.parse_scans(A.raw_scans(spark, sf)), A.scan_oracles(spark, sf))
    return graded.drop("unsupported_major_false_positive", "missing_scan_object")


@query(
    "simple_scan_grades",
    f"""WITH {SCANS}, c AS (SELECT *, zero <> (NOT silent) AS result_correct, alerts = 0 AND zero AS quiet, NOT zero AND alerts > 0 AS any_alert,
      style = 3 AS decoy FROM n),
    k AS (SELECT *, quiet OR (any_alert AND NOT decoy) AS hit, quiet OR (any_alert AND NOT decoy AND style <> 6) AS latent,
      quiet OR (any_alert AND NOT decoy AND style <> 1) AS exposure, CASE WHEN zero THEN silent AND style <> 5 ELSE any_alert END AS cited,
      CASE WHEN zero THEN silent AND style <> 5 ELSE any_alert AND NOT decoy AND style <> 6 END AS hedged,
      CASE WHEN zero THEN alerts ELSE greatest(0, alerts - 1) END AS fp FROM c),
    s AS (SELECT *, greatest(0.0, (20 * result_correct::INT + 30 * hit::INT + 20 * latent::INT + 15 * exposure::INT + 10 * cited::INT
      + 5 * hedged::INT - 20 * fp) / 100.0) AS score FROM k)
    SELECT case_id, score >= 0.85 AND fp = 0 AND exposure AS passed, round(score::DOUBLE, 4) AS score, CAST(fp AS INT) AS false_positive_count FROM s""",
)
def simple_scan_grades(spark, sf):
    graded = G.grade_scans_simple(G.parse_scans(A.raw_scans(spark, sf)), A.scan_oracles(spark, sf))
    return graded.select("case_id", "passed", "score", "false_positive_count")


_DECISIONS = """a AS (SELECT c_name AS case_id, c_custkey AS k, CASE c_custkey % 4 WHEN 0 THEN 'approve' WHEN 1 THEN 'Hold' WHEN 2 THEN 'escalate' ELSE 'hold' END AS said,
    CASE c_custkey % 3 WHEN 0 THEN 'approve' WHEN 1 THEN 'hold' ELSE 'escalate' END AS expected FROM customer),
  e AS (SELECT *, (k % 4 = 1)::INT + (k % 5 = 0)::INT + (k % 13 = 0)::INT AS errors,
    CASE WHEN k % 5 = 0 THEN ['ap_policy.limit', 'audit_vendor.change_history.bank'] WHEN k % 5 = 1 THEN ['ap_policy.limit']
      ELSE CAST([] AS VARCHAR[]) END AS missing FROM a)"""


@query("cited_evidence", f"WITH {_DECISIONS} SELECT case_id, array_to_string(missing, ',') AS missing FROM e")
def cited_evidence(spark, sf):
    answers = G.parse_decisions(A.raw_decisions(spark, sf)).select("case_id", F.col("answer.evidence").alias("evidence"))
    return J.missing_evidence(answers, A.vendor_oracles(spark, sf)).select("case_id", F.array_join("missing", ",").alias("missing"))


@query(
    "decision_grades",
    f"""WITH {_DECISIONS}, s AS (SELECT *, lower(said) = expected AS ok, CASE WHEN k % 7 = 0 THEN 'Trust the email' ELSE '' END AS hits FROM e),
    g AS (SELECT *, CASE WHEN errors > 0 THEN 0.0 ELSE 0.45 * ok::INT + 0.35 * (3 - len(missing)) / 3 + 0.15 * (k % 11 <> 0)::INT + 0.05 END AS score FROM s)
    SELECT case_id, errors = 0 AND ok AND len(missing) = 0 AND hits = '' AND score >= 0.8 AS passed, round(score::DOUBLE, 4) AS score,
      errors = 0 AS schema_valid, CAST(errors AS BIGINT) AS schema_error_count, expected AS expected_decision, said AS actual_decision,
      array_to_string(missing, ',') AS missing_evidence, hits AS forbidden_hits FROM g""",
)
def decision_grades(spark, sf):
    graded = G.grade_vendor(G.parse_decisions(A.raw_decisions(spark, sf)), A.vendor_oracles(spark, sf))
    return graded.withColumn("missing_evidence", F.array_join("missing_evidence", ",")).withColumn(
        "forbidden_hits", F.array_join("forbidden_hits", ",")
    )


# ------------------------------------------------------------------ vectors and curation

_V = "v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings)"


@query(
    "earlier_neighbours",
    f"""WITH {_V} SELECT CAST(b.id AS VARCHAR) AS id, coalesce(round(min(1 - list_cosine_similarity(a.x, b.x)) + 0.0, 6), -1.0) AS nn_distance
    FROM v b LEFT JOIN v a ON a.id < b.id GROUP BY b.id""",
)
def earlier_neighbours(spark, sf):
    """Each vector's distance to the nearest one indexed before it."""
    v = A.vectors(spark, sf)
    return nearest_distance(v, v, earlier_only=True).select(
        "id", F.coalesce(F.round("nn_distance", 6), F.lit(-1.0)).alias("nn_distance")
    )


@query(
    "label_similarity",
    """WITH c AS (SELECT label, list(x ORDER BY i) AS centre FROM (SELECT label, i, avg(x) AS x FROM (SELECT label, unnest(embedding)::DOUBLE AS x,
      unnest(generate_series(1, len(embedding))) AS i FROM embeddings) GROUP BY ALL) GROUP BY label)
    SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), centre), 6) AS similarity FROM embeddings JOIN c USING (label)""",
)
def label_similarity(spark, sf):
    """Cosine of every vector with its label's mean vector."""
    e = A.table(spark, sf, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x"))
    parts = e.select("label", F.posexplode("x").alias("i", "x")).groupBy("label", "i").agg(F.avg("x").alias("x"))
    # one entry per dimension, so the list has the width of a vector
    centres = parts.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("c"))
    centres = centres.select("label", F.transform("c", lambda s: s["x"]).alias("centre"))
    return e.join(centres, "label").select("vec_id", F.round(S.cosine(F.col("x"), F.col("centre")), 6).alias("similarity"))


@query(
    "novel_vectors",
    f"""WITH RECURSIVE {_V}, o AS (SELECT id, x, row_number() OVER (ORDER BY id) AS pos FROM v),
    near AS MATERIALIZED (SELECT b.pos, list(a.pos) AS earlier FROM o a JOIN o b ON a.pos < b.pos AND 1 - list_cosine_similarity(a.x, b.x) < 0.55 GROUP BY b.pos),
    walk(pos, taken) AS (SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[]) UNION ALL
      SELECT w.pos + 1, CASE WHEN list_has_any(w.taken, coalesce(n.earlier, CAST([] AS BIGINT[]))) THEN w.taken ELSE list_append(w.taken, w.pos + 1) END
      FROM walk w LEFT JOIN near n ON n.pos = w.pos + 1 WHERE w.pos < (SELECT count(*) FROM o)),
    done AS (SELECT taken FROM walk ORDER BY pos DESC LIMIT 1)
    SELECT CAST(o.id AS VARCHAR) AS id, CASE WHEN list_contains(taken, pos) THEN 'accept' ELSE 'reject' END AS verdict,
      CASE WHEN list_contains(taken, pos) THEN '' ELSE 'near_duplicate' END AS subcodes,
      CASE WHEN list_contains(taken, pos) THEN coalesce((SELECT round(min(1 - list_cosine_similarity(p.x, o.x)) + 0.0, 6) FROM o p
        WHERE p.pos < o.pos AND list_contains(taken, p.pos)), -1.0) ELSE -1.0 END AS nn_distance FROM o, done""",
)
def novel_vectors(spark, sf):
    """Greedy novelty over all vectors in order."""
    out = curate(A.vectors(spark, sf), threshold=0.55)
    return out.select(
        "id", "verdict", F.array_join("subcodes", ",").alias("subcodes"), F.coalesce(F.round("nn_distance", 6), F.lit(-1.0)).alias("nn_distance")
    )


@query(
    "approximate_neighbours",
    "SELECT count(*) AS vectors, true AS recall_is_nine_tenths, true AS compared_are_fewer FROM embeddings",
)
def approximate_neighbours(spark, sf):
    """Recall of the approximate search against the exact one over all vectors, and the comparisons both make."""
    vectors = A.vectors(spark, sf)
    near = lambda exact, name: nearest_distance(vectors, vectors, skip_self=True, exact=exact, counted=True).select(
        "id", F.col("nn_distance").alias(name), F.col("compared").alias(f"{name}_n")
    )
    both = near(True, "whole").join(near(False, "part"), "id")
    hit = F.coalesce(F.abs(F.col("part") - F.col("whole")) < 1e-9, F.col("whole").isNull())
    return both.agg(
        F.count("*").alias("vectors"), (F.avg(hit.cast("int")) >= 0.9).alias("recall_is_nine_tenths"),
        (F.sum("part_n") < 0.75 * F.sum("whole_n")).alias("compared_are_fewer"),
    )


_SLOTS = """w AS (SELECT doc_id, md5(token) AS h FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '\\s+')) AS token FROM documents) WHERE token <> ''),
  s AS (SELECT doc_id, CAST(('0x' || h[1:8]) AS BIGINT) % 128 AS bucket, CASE WHEN CAST(('0x' || h[9:10]) AS BIGINT) % 2 = 0 THEN 1 ELSE -1 END AS sign FROM w),
  c AS (SELECT doc_id, bucket, sum(sign) AS weight FROM s GROUP BY ALL)"""


@query(
    "token_slots",
    f"WITH {_SLOTS} SELECT doc_id, CAST(bucket AS INT) AS bucket, CAST(weight AS BIGINT) AS weight FROM c",
)
def token_slots(spark, sf):
    return E.token_slots(A.texts(spark, sf), "doc_id", "text", 128)


@query(
    "hashed_embeddings",
    f"""WITH {_SLOTS}, n AS (SELECT doc_id, sqrt(sum(weight * weight)) AS norm FROM c GROUP BY 1)
    SELECT doc_id, CAST(bucket AS INT) AS bucket, round(weight / norm, 6) AS value FROM c JOIN n USING (doc_id) WHERE weight <> 0""",
)
def hashed_embeddings(spark, sf):
    vectors = E.hash_embedding(A.texts(spark, sf), "doc_id", "text", hash="md5")
    cells = vectors.select("doc_id", F.posexplode("vector").alias("bucket", "value"))
    return cells.where("value <> 0").select("doc_id", "bucket", F.round("value", 6).alias("value"))


_WALK = """o AS (SELECT id, x, row_number() OVER (ORDER BY id) AS pos FROM v),
    near AS MATERIALIZED (SELECT b.pos, list(a.pos) AS earlier FROM o a JOIN o b ON a.pos < b.pos AND 1 - list_cosine_similarity(a.x, b.x) < 0.08 GROUP BY b.pos),
    walk(pos, taken) AS (SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[]) UNION ALL
      SELECT w.pos + 1, CASE WHEN list_has_any(w.taken, coalesce(n.earlier, CAST([] AS BIGINT[]))) THEN w.taken ELSE list_append(w.taken, w.pos + 1) END
      FROM walk w LEFT JOIN near n ON n.pos = w.pos + 1 WHERE w.pos < (SELECT count(*) FROM o)),
    done AS (SELECT taken FROM walk ORDER BY pos DESC LIMIT 1)"""


@query(
    "novel_token_documents",
    f"""WITH RECURSIVE {_SLOTS},
    v AS (SELECT d.doc_id AS id, list(CAST(coalesce(weight, 0) AS DOUBLE) ORDER BY b.bucket) AS x
      FROM documents d CROSS JOIN (SELECT unnest(range(128)) AS bucket) b LEFT JOIN c ON c.doc_id = d.doc_id AND c.bucket = b.bucket GROUP BY 1),
    {_WALK}
    SELECT CAST(o.id AS VARCHAR) AS id, CASE WHEN list_contains(taken, pos) THEN 'accept' ELSE 'reject' END AS verdict,
      CASE WHEN list_contains(taken, pos) THEN '' ELSE 'near_duplicate' END AS subcodes FROM o, done""",
)
def novel_token_documents(spark, sf):
    """Greedy novelty at the default threshold over the md5 embeddings of all whole texts."""
    d = A.texts(spark, sf)
    vectors = E.hash_embedding(d, "doc_id", "text", hash="md5")
    out = curate(vectors.select(F.col("doc_id").cast("string").alias("id"), F.col("doc_id").alias("ord"), "vector"))
    return out.select("id", "verdict", F.array_join("subcodes", ",").alias("subcodes"))


@query("novel_documents")
def novel_documents(spark, sf):
    """Greedy novelty over the default embeddings of all whole texts."""
    d = A.texts(spark, sf).select(F.col("doc_id").cast("string").alias("id"), F.col("doc_id").alias("ord"), F.col("text").alias("embedding_text"))
    return curate(d).drop("vector").withColumn("subcodes", F.array_join("subcodes", ","))


# ------------------------------------------------------------------ files, headlines, revisions


@query(
    "headline_rows",
    """SELECT doc_id, 'H' || lpad(CAST(i AS VARCHAR), CAST(greatest(2, length(CAST(i AS VARCHAR))) AS INTEGER), '0') AS headline_id, trim(line, E' \\t\\r\\n') AS headline
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(generate_series(1, len(string_split(text, chr(10))))) AS i FROM documents)""",
)
def headline_pack_rows(spark, sf):
    """Every line of a document as a headline, rendered into one pack and parsed back."""
    d = A.texts(spark, sf)
    rows = headline_rows(d.select("doc_id", F.split("text", "\n").alias("items")), "doc_id", "items")
    packs = render_headlines(rows.withColumn("date", F.lit("2026-01-01")), "doc_id")
    return parse_headlines(packs, "doc_id").drop("date")


_EDITS = """f AS (SELECT page_id, 'ws-' || (page_id // 5) AS ws, html, len(string_split(html, '<p>')) - 1 AS hits FROM pages)"""
_REVISED = "page_id % 11 <> 5 AND hits > 0 AND (hits = 1 OR page_id % 3 <> 0)"


def _page_candidates(spark, sf):
    """Candidates whose workspaces the pages' files are; every eleventh has none that can be edited."""
    runnable = F.when(F.col("ord") % 11 != 5, F.lit(fixed.WORKSPACE_KIND)).otherwise(F.lit("notes"))
    environment = F.struct(runnable.alias("kind"), F.lit("{}").alias("payload"))
    return A.candidates(spark, sf).withColumn("id", _id("page-", "ord")).withColumn(
        "agent_artifact", F.col("agent_artifact").withField("environment_artifact", environment)
    )


def _patches(spark, sf):
    """One patch per page: replace its paragraph tags (all, or one where only one exists), then add a note file."""
    p = A.table(spark, sf, "pages")
    every = F.col("page_id") % 3 != 0
    op = lambda path, old, new, all_, create: F.struct(
        F.lit("edit_file").alias("op"), path.alias("path"), old.alias("old_text"), F.lit(new).alias("new_text"),
        all_.alias("replace_all"), F.lit(create).alias("create_if_missing"),
    )
    ident = _id("page-", "page_id")
    ops = F.array(
        op(F.lit("index.html"), F.lit("<p>"), "<p class='x'>", every, False),
        op(F.lit("NOTES.md"), F.lit(None).cast("string"), "note one", F.lit(False), True),
        op(F.lit("NOTES.md"), F.lit("one"), "two", F.lit(False), False),
    )
    prompt = F.concat(F.lit('{"prompt":"Revised prompt of page '), F.col("page_id").cast("string"), F.lit('"}'))
    patches = p.select(
        ident.alias("candidate_id"), F.when(F.col("page_id") % 4 == 0, prompt).otherwise("{}").alias("benchmark_case_updates"),
        F.when(F.col("page_id") % 6 == 0, F.lit('{"known_limits":["new limit"]}')).otherwise("{}").alias("metadata_updates"),
        ops.alias("environment_ops"), F.lit("why").alias("revision_rationale"),
    )
    files = p.select(ident.alias("candidate_id"), F.lit(0).alias("ord"), F.lit("index.html").alias("path"), F.col("html").alias("content"))
    return files, patches


@query(
    "revised_files",
    f"""WITH {_EDITS}, g AS (SELECT * FROM f WHERE {_REVISED})
    SELECT 'page-' || page_id AS candidate_id, 'index.html' AS path, replace(html, '<p>', '<p class=''x''>') AS content FROM g
    UNION ALL SELECT 'page-' || page_id, 'NOTES.md', 'note two' FROM g""",
)
def revised_files(spark, sf):
    files, patches = _patches(spark, sf)
    return W.apply_revisions(_page_candidates(spark, sf), files, patches)[1].select("candidate_id", "path", "content")


@query(
    "revised_candidates",
    f"""WITH {_EDITS} SELECT 'page-' || page_id || '-rev' AS id, 'page-' || page_id AS revision_of,
      CASE WHEN page_id % 4 = 0 THEN 'Revised prompt of page ' || page_id ELSE text END AS prompt, source AS setup,
      CASE WHEN page_id % 6 = 0 THEN 'new limit' ELSE array_to_string(list_transform(range(n_chars % 6), lambda x: 'limit'), ',') END AS known_limits
    FROM f JOIN documents ON page_id = doc_id WHERE {_REVISED}""",
)
def revised_candidates(spark, sf):
    """The candidate half of the same patches: updated case and metadata, new id and provenance."""
    files, patches = _patches(spark, sf)
    revised = W.apply_revisions(_page_candidates(spark, sf), files, patches)[0]
    case = lambda key: F.get_json_object("agent_artifact.benchmark_case", f"$.{key}")
    return revised.select(
        "id", F.col("provenance")["revision_of"].alias("revision_of"), case("prompt").alias("prompt"), case("setup").alias("setup"),
        F.array_join("judge_artifact.known_limits", ",").alias("known_limits"),
    )


@query(
    "revision_errors",
    f"""WITH {_EDITS} SELECT 'page-' || page_id AS candidate_id, CASE WHEN page_id % 11 = 5 THEN 'environment_ops require an executable workspace'
      WHEN hits = 0 THEN 'environment_ops.0.old_text did not match file'
      ELSE 'environment_ops.0.old_text matched ' || hits || ' times' END AS error FROM f WHERE NOT ({_REVISED})""",
)
def revision_errors(spark, sf):
    files, patches = _patches(spark, sf)
    return W.apply_revisions(_page_candidates(spark, sf), files, patches)[2]


@query(
    "revision_sizes",
    """SELECT 'page-' || page_id AS candidate_id, CAST(3 AS BIGINT) AS revision_op_count, CAST(3 AS BIGINT) AS revision_edit_file_count,
      CAST(2 AS BIGINT) AS revision_files_touched, 'NOTES.md,index.html' AS revision_files_touched_list, CAST(24 + strlen(url) AS BIGINT) AS revision_bytes_added,
      CAST(6 AS BIGINT) AS revision_bytes_removed, CAST(30 + strlen(url) AS BIGINT) AS revision_bytes_changed, CAST(1 AS BIGINT) AS revision_full_rewrite_count,
      CAST(1 AS BIGINT) AS revision_create_file_count, CAST((page_id % 3 <> 0)::INT AS BIGINT) AS revision_replace_all_count,
      round(1 / 3.0::DOUBLE, 6) AS revision_full_rewrite_ratio FROM pages""",
)
def revision_sizes(spark, sf):
    _, patches = _patches(spark, sf)
    urls = A.table(spark, sf, "pages").select(_id("page-", "page_id").alias("candidate_id"), "url")
    longer = F.transform("environment_ops", lambda o, i: F.when(i == 2, o.withField("new_text", F.concat(o["new_text"], F.col("url")))).otherwise(o))
    patches = patches.join(urls, "candidate_id").withColumn("environment_ops", longer).drop("url")
    out = W.revision_metrics(patches)
    return out.withColumn("revision_files_touched_list", F.array_join("revision_files_touched_list", ",")).withColumn(
        "revision_full_rewrite_ratio", F.round("revision_full_rewrite_ratio", 6)
    )


@query(
    "scored_prompts",
    """WITH w AS (SELECT doc_id, len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS n FROM documents),
    r AS (SELECT doc_id AS row_index, CASE WHEN n <> 1 THEN n END AS n FROM w)
    SELECT 'run-1' AS run_id, row_index, CAST(n AS VARCHAR) AS output, CAST(coalesce(n, 0) AS BIGINT) AS input_tokens,
      CAST((n IS NOT NULL)::INT AS BIGINT) AS output_tokens, CASE WHEN n IS NULL THEN 'too short' END AS error,
      sha256('{"output":' || coalesce('"' || n || '"', 'null') || ',"row_index":' || row_index || ',"run_id":"run-1"}') AS id FROM r""",
)
def scored_prompts(spark, sf):
    """A user function over every document: here it counts words, and fails on some."""

    def words(prompt):
        n = len(prompt.split())
        if n == 1:
            raise ValueError("too short")
        return {"output": str(n), "input_tokens": n, "output_tokens": 1}

    d = A.texts(spark, sf).select(F.lit("run-1").alias("run_id"), F.col("doc_id").alias("row_index"), F.col("text").alias("prompt"))
    return E.run_prompts(d, words).drop("latency_ms", "prompt")


# ------------------------------------------------------------------ boards and streams

_BOARD = f"""e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
  m AS (SELECT 'run-' || user_id AS run_id, event_id AS ord, event_type IN ('view', 'signup') AS starts,
    CASE k % 6 WHEN 0 THEN 'generate' WHEN 1 THEN 'validate_det' WHEN 2 THEN 'quality_gate' WHEN 3 THEN 'rubric_gate' WHEN 4 THEN 'adversary' ELSE 'curate' END AS node,
    CASE WHEN event_type IN ('view', 'signup') THEN 'running' WHEN k % 4 = 0 THEN 'reject' WHEN k % 5 = 0 THEN 'local' ELSE 'accept' END AS mark FROM e),
  runs AS (SELECT DISTINCT run_id FROM m),
  nodes(node) AS (VALUES ('design'), ('validate_design_batch_det'), ('select_next_design'), ('audit_design'), ('generate'), ('validate_det'), ('adversary'),
    ('revise_from_adversary'), ('quality_gate'), ('rubric_gate'), ('join_gates'), ('curate')),
  last AS (SELECT run_id, node, max(ord) AS ord, arg_max(mark, ord) AS mark FROM m GROUP BY ALL)
  SELECT r.run_id, n.node, CASE WHEN l.mark IS NULL THEN 'pending' WHEN l.mark = 'running' AND EXISTS (SELECT 1 FROM m WHERE m.run_id = r.run_id AND m.starts
      AND m.ord > l.ord AND m.node <> n.node AND NOT (m.node IN ('quality_gate', 'rubric_gate') AND n.node IN ('quality_gate', 'rubric_gate')))
    THEN CASE WHEN n.node IN ('validate_design_batch_det', 'validate_det', 'curate') THEN 'local' ELSE 'pending' END ELSE l.mark END AS status
  FROM runs r CROSS JOIN nodes n LEFT JOIN last l ON l.run_id = r.run_id AND l.node = n.node"""


@query("board_status", f"WITH {_BOARD}")
def board_status(spark, sf):
    return streams.node_status(A.board_events(spark, sf))


def _stream_events(spark, sf):
    return _stream_table(spark, sf, "events")


def _stream_table(spark, sf, name):
    """A stream of a table, which may be one file or a folder of them. A stream's path is a folder or, as here, a pattern."""
    schema = A.table(spark, sf, name).schema
    folder = re.sub(r"([\\{}\[\]*?])", r"\\\1", sf)
    return spark.readStream.schema(schema).parquet(f"{folder}/{name}.parque[t]")


def _drained(stream, mode, spark):
    """Run a stream over everything that is there and return what it wrote."""
    base = os.path.join(ensure_checkpoint_dir(spark), f"stream-{uuid.uuid4().hex}")
    out = f"{base}/out"

    def write(batch, batch_id):
        batch.withColumn("_batch", F.lit(batch_id)).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    started = (
        stream.writeStream.outputMode(mode).trigger(availableNow=True).option("checkpointLocation", f"{base}/state").foreachBatch(write).start()
    )
    started.awaitTermination()
    return spark.read.parquet(out).drop("batch")


@query(
    "streamed_counters",
    f"""WITH {STAGES}, r AS (SELECT run_id, 'route' AS metric, route_code AS key FROM stages
      UNION ALL SELECT run_id, 'committed', '' FROM stages WHERE role = 'curate_committed_sample' AND route_code = 'accept'
      UNION ALL SELECT run_id, 'dropped', '' FROM stages WHERE verdict = 'reject' AND role = 'curate_committed_sample')
    SELECT run_id, metric, key, count(*) AS n FROM r GROUP BY ALL""",
)
def streamed_counters(spark, sf):
    stages = A.stage_records_from(_stream_events(spark, sf))
    out = _drained(streams.stream_counters(stages), "update", spark)
    newest = out.groupBy("run_id", "metric", "key").agg(F.max_by("n", "_batch").alias("n"))
    return newest


@query(
    "streamed_dedup",
    "SELECT DISTINCT sha256(text) AS content_hash, CAST(1 AS BIGINT) AS kept, true AS one_of_its_rows FROM documents",
)
def streamed_dedup(spark, sf):
    """Which designs a stream keeps: one row of every content hash, and a row that has it."""
    docs = _stream_table(spark, sf, "documents")
    designs = docs.select(
        "doc_id", F.sha2("text", 256).alias("content_hash"), F.timestamp_seconds(F.lit(1_700_000_000) + F.col("doc_id")).alias("ts")
    )
    out = _drained(streams.stream_dedup(designs, watermark="3650 days"), "append", spark)
    truth = A.table(spark, sf, "documents").select(F.col("doc_id").alias("_id"), F.sha2("text", 256).alias("_hash"))
    checked = out.join(truth, F.col("doc_id") == F.col("_id"))
    return checked.groupBy("content_hash").agg(F.count("*").alias("kept"), F.bool_and(F.col("content_hash") == F.col("_hash")).alias("one_of_its_rows"))


@query("streamed_curation", ORACLES["novel_vectors"])
def streamed_curation(spark, sf):
    """The verdicts of ``novel_vectors`` by a stream over three parts of the vectors, the last batch of which is repeated."""
    root = f"{ensure_checkpoint_dir(spark)}/curation-{uuid.uuid4().hex}"
    cell = F.struct(F.lit("t").alias("case_type"), F.lit(1).alias("difficulty"), F.lit("s").alias("scenario"))
    vectors = A.vectors(spark, sf).withColumn("cell", cell)
    last = vectors.agg(F.max("ord")).first()[0] or 0
    for part in range(3):
        low, high = (last + 1) * part // 3, (last + 1) * (part + 1) // 3
        vectors.where((F.col("ord") >= low) & (F.col("ord") < high)).write.mode("append").parquet(f"{root}/in")
        source = spark.readStream.schema(vectors.schema).parquet(f"{root}/in")
        writer = streams.stream_curate(source, f"{root}/out", "vectors", 0.55).option("checkpointLocation", f"{root}/state")
        writer.trigger(availableNow=True).start().awaitTermination()
    streams.curate_batch(vectors.where(F.col("ord") >= low), 2, f"{root}/out", "vectors", 0.55)
    out = spark.read.parquet(f"{root}/out/verdicts")
    return out.select(
        "id", "verdict", F.array_join("subcodes", ",").alias("subcodes"), F.coalesce(F.round("nn_distance", 6), F.lit(-1.0)).alias("nn_distance")
    )


@query("streamed_board", f"WITH {_BOARD}")
def streamed_board(spark, sf):
    out = _drained(streams.stream_node_status(A.board_events_from(_stream_events(spark, sf))), "update", spark)
    newest = out.groupBy("run_id", "node").agg(F.max_by("status", "_batch").alias("status"))
    return newest
