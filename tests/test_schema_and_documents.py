import json

import pytest
from pyspark.sql import functions as F

from casemill.functions import documents as D
from casemill.functions import embed as E
from casemill.functions import scalars as S
from casemill.functions import text as T
from casemill.operators.checks import check_text_hygiene
from casemill.operators.document_schema import check_schema, compile_schema, schema_errors
from casemill.operators.grade import scan_schema_valid
from casemill.sources.domain import bind_case_schema, domain_tables, load_domain

SCHEMA = {
    "type": "object",
    "additionalProperties": False,
    "required": ["name", "dims"],
    "properties": {
        "name": {"type": "string", "pattern": "^[a-z]+$", "minLength": 2},
        "n": {"type": "integer", "minimum": 0, "maximum": 5},
        "flag": {"type": ["boolean", "null"]},
        "dims": {"type": "array", "minItems": 1, "maxItems": 2, "items": {"$ref": "#/$defs/dim"}},
    },
    "$defs": {"dim": {"type": "object", "required": ["w"], "properties": {"w": {"type": "number"}}}},
}
GOOD = {"name": "ab", "dims": [{"w": 1}]}
CASES = {
    "good": (GOOD, None),
    "float integer": ({**GOOD, "n": 1.0}, None),
    "bool is not integer": ({**GOOD, "n": True}, "n"),
    "fraction": ({**GOOD, "n": 1.5}, "n"),
    "null flag": ({**GOOD, "flag": None}, None),
    "extra": ({**GOOD, "x": 1}, ""),
    "missing": ({"name": "ab"}, ""),
    "pattern": ({**GOOD, "name": "AB"}, "name"),
    "length": ({**GOOD, "name": "a"}, "name"),
    "max": ({**GOOD, "n": 9}, "n"),
    "empty array": ({**GOOD, "dims": []}, "dims"),
    "long array": ({**GOOD, "dims": [{"w": 1}] * 3}, "dims"),
    "nested": ({**GOOD, "dims": [{"w": 1}, {"w": "x"}]}, "dims.1.w"),
    "nested missing": ({**GOOD, "dims": [{}]}, "dims.0"),
    "two errors sort by path": ({"name": "A", "dims": [{"w": "x"}]}, "dims.0.w"),
}


def test_schema_keywords(spark):
    rows = [(k, json.dumps(v[0])) for k, v in CASES.items()]
    got = check_schema(spark.createDataFrame(rows, "id string, body string"), "body", compile_schema(SCHEMA), "s")
    seen = {r["candidate_id"]: (r["evidence"][0]["path"] if r["evidence"] else None) for r in got.collect()}
    assert seen == {k: v[1] for k, v in CASES.items()}


def test_array_positions_sort_as_numbers(spark):
    body = json.dumps({"name": "ab", "dims": [{"w": 1}] * 2 + [{"w": "x"}] + [{"w": 1}] * 7 + [{"w": "y"}]})
    rules = [r for r in compile_schema(SCHEMA) if r[2] == "type"]
    errors = schema_errors(spark.createDataFrame([("d", body)], "id string, body string"), "body", rules).orderBy("sort_path")
    assert [r["path"] for r in errors.collect()] == ["dims.2.w", "dims.10.w"]


def test_unknown_keyword_is_refused():
    with pytest.raises(ValueError):
        compile_schema({"anyOf": []})


def test_every_missing_name_is_a_violation(spark):
    rules = compile_schema({"type": "object", "required": ["c", "a", "b"]})
    docs = spark.createDataFrame([("d", "{}"), ("e", '{"a": 1}')], "id string, body string")
    got = sorted((r["id"], r["nth"], r["message"]) for r in schema_errors(docs, "body", rules).collect())
    lacks = lambda id_, *names: [(id_, n, f"'{name}' is a required property") for n, name in enumerate(names)]
    assert got == lacks("d", "c", "a", "b") + lacks("e", "c", "b")
    first = {r["candidate_id"]: r["evidence"][0]["value"] for r in check_schema(docs, "body", rules, "s").collect()}
    assert first == {"d": "'c' is a required property", "e": "'c' is a required property"}


def test_hygiene_finds_keys_with_dots_and_texts_that_are_not_json(spark):
    docs = spark.createDataFrame([("dot", '{"a\u200b.b": 1}'), ("raw", "no json \u200b here"), ("ok", '{"a.b": "c"}')], "id string, body string")
    found = {r["candidate_id"]: (r["passed"], r["evidence"][0]["value"][:6] if r["evidence"] else None) for r in check_text_hygiene(docs, "body").collect()}
    assert found == {"dot": (False, "U+200B"), "raw": (False, "U+200B"), "ok": (True, None)}


def test_not_json_is_a_violation(spark):
    got = check_schema(spark.createDataFrame([("d", "{")], "id string, body string"), "body", compile_schema(SCHEMA), "s").first()
    assert not got["passed"]


def test_contract_loads_and_binds(spark, tmp_path):
    (tmp_path / "out.json").write_text(
        json.dumps({"type": "object", "required": ["c"], "properties": {"c": {"$ref": "#/$defs/benchmark_case"}}, "$defs": {}})
    )
    (tmp_path / "d.yaml").write_text(
        "domain_id: d\ncase_types: [a]\ndifficulties: [1, 2, 3]\nscenarios: [s]\nroute_codes: [accept]\nsubcodes: [x]\n"
        "deterministic_rules: {min_hidden_tests: 2}\noutput_schema_path: out.json\n"
        "benchmark_case_schema: {$schema: u, type: object, required: [p], properties: {p: {type: string, minLength: 30}}}\n"
    )
    domain = load_domain(str(tmp_path / "d.yaml"))
    assert domain.output_schema["$defs"]["benchmark_case"]["required"] == ["p"]
    assert "$schema" not in domain.output_schema["$defs"]["benchmark_case"]
    assert domain.minimum("min_hidden_tests", 1) == 2
    tables = domain_tables(spark, domain)
    assert tables["allowed"].where("kind = 'difficulty'").count() == 3
    assert bind_case_schema({}, {"type": "object"}) == {}


def test_nodes_and_table_function_agree(spark):
    body = '{"a":{"b":[1,"x",{"c":null}]},"d":true}'
    df = spark.createDataFrame([(1, body)], "id int, body string")
    nodes = [(r["ord"], r["index_path"], r["kind"]) for r in D.json_nodes(df, "body", "id").orderBy("ord").collect()]
    assert nodes[3:6] == [(3, ".a.b[0]", "number"), (4, ".a.b[1]", "string"), (5, ".a.b[2]", "object")]
    D.register_json_nodes(spark)
    df.createOrReplaceTempView("bodies")
    same = spark.sql("SELECT ord, index_path, kind FROM bodies, LATERAL json_nodes(bodies.body) ORDER BY ord").collect()
    assert [tuple(r) for r in same] == nodes


def test_canonical_json_matches_sorted_compact_json(spark):
    value = {"b": [1, {"z": "é", "a": None}], "a": 1.5}
    df = spark.createDataFrame([(json.dumps(value, indent=2),), ("{",)], "j string")
    got = [r[0] for r in df.select(D.canonical_json(F.col("j"))).collect()]
    assert got == [json.dumps(value, sort_keys=True, separators=(",", ":")), None]


def test_text_repair(spark):
    df = spark.createDataFrame([("caf\x00c3\x00a9 é",), ("bad \x00ff",), ("plain",), (None,)], "t string")
    got = [tuple(r[0]) for r in df.select(T.normalize_text(F.col("t"))).collect()]
    assert got == [("café é", 2), ("bad ÿ", 1), ("plain", 0), (None, 0)]
    assert df.where(T.has_disallowed(F.col("t"))).count() == 2


def test_blake_embedding_matches_its_definition(spark):
    import hashlib

    text = "Alpha beta  alpha"
    want = [0.0] * 128
    for token in text.lower().split():
        d = hashlib.blake2b(token.encode(), digest_size=16).digest()
        want[int.from_bytes(d[:4], "big") % 128] += 1.0 if d[4] % 2 == 0 else -1.0
    size = sum(v * v for v in want) ** 0.5
    got = spark.createDataFrame([(text,), ("",)], "t string").select(E.blake_embed(F.col("t")).alias("v")).collect()
    assert got[0]["v"] == pytest.approx([v / size for v in want])
    assert got[1]["v"] == [0.0] * 128


def test_user_embedder_and_scorer(spark):
    df = spark.createDataFrame([("r", 0, "ab"), ("r", 1, "fail")], "run_id string, row_index int, prompt string")
    assert [r["vector"] for r in E.embed(df, "prompt", lambda texts: [[len(t)] for t in texts]).collect()] == [[2.0], [4.0]]

    def fn(prompt):
        if prompt == "fail":
            raise RuntimeError("provider down")
        return {"output": prompt.upper(), "input_tokens": 1}

    rows = {r["row_index"]: r for r in E.run_prompts(df, fn).collect()}
    assert rows[0]["output"] == "AB" and rows[0]["error"] is None and rows[1]["error"] == "provider down"
    assert rows[0]["id"] != rows[1]["id"]


def test_answer_envelopes(spark):
    raws = {
        '{"decision":"hold"}': '{"decision":"hold"}',
        '{"answer":{"decision":"hold"}}': '{"decision":"hold"}',
        '{"answer":"not json","output":"{\\"decision\\":\\"hold\\"}"}': '{"decision":"hold"}',
        '"{\\"decision\\":\\"hold\\"}"': '{"decision":"hold"}',
        '{"x":1}': '{"x":1}',
    }
    df = spark.createDataFrame([(r,) for r in raws], "raw string")
    got = {r["raw"]: r["j"] for r in df.select("raw", F.to_json(S.unwrap_answer(F.col("raw"))).alias("j")).collect()}
    assert got == raws


def test_evidence_aliases(spark):
    ev = [("result.amount", "records/invoice.json"), ("audit.view.result.bank", "audit_vendor view"), ("k", "notes.md")]
    df = spark.createDataFrame([(ev,)], "e array<struct<key:string,source:string>>")
    got = set(df.select(S.evidence_aliases(F.col("e"))).first()[0])
    assert {"result.amount", "invoice.amount", "audit_vendor.view.bank", "k", "notes.k"} <= got


def test_scan_structure(spark):
    alert = {k: [] for k in ("source_headlines", "enterprise_path", "uncertainty")}
    alert.update({k: "" for k in ("id", "confidence", "latent_edge_hypothesis", "real_world_prior", "reasoning")})
    alert["business_exposure"] = {k: None for k in ("revenue_at_risk", "affected_orders", "affected_customers", "constrained_inventory")}
    alert["citations"] = {"headlines": [], "records": []}
    scan = {"run_id": "r", "result": "alerts_found", "alerts": [alert], "no_alert_rationale": None}
    docs = {
        "full": (scan, True),
        "no alerts": ({**scan, "alerts": []}, True),
        "rationale missing": ({k: v for k, v in scan.items() if k != "no_alert_rationale"}, False),
        "bad result": ({**scan, "result": "x"}, False),
        "alerts not a list": ({**scan, "alerts": {}}, False),
        "alert without id": ({**scan, "alerts": [{k: v for k, v in alert.items() if k != "id"}]}, False),
        "records not a list": ({**scan, "alerts": [{**alert, "citations": {"headlines": [], "records": "x"}}]}, False),
        "not an object": ([], False),
    }
    df = spark.createDataFrame([(k, json.dumps(v[0])) for k, v in docs.items()], "id string, j string")
    got = {r["id"]: r["ok"] for r in df.select("id", scan_schema_valid(F.parse_json("j")).alias("ok")).collect()}
    assert got == {k: v[1] for k, v in docs.items()}


def test_long_texts_are_python_objects_a_few_at_a_time():
    import json

    import pyarrow as pa
    from pyspark.sql import types as T

    from casemill.functions import documents as D

    alive, most = 0, 0

    class Text(str):
        def __new__(cls, text):
            nonlocal alive, most
            alive += 1
            most = max(most, alive)
            return super().__new__(cls, text)

        def __del__(self):
            nonlocal alive
            alive -= 1

    texts = pa.array([json.dumps({"b": i, "a": "x"}) for i in range(1000)] + [None])
    out = D._each(T.StringType(), lambda t: t and Text(json.dumps(json.loads(t), sort_keys=True)), texts)
    assert most <= 2 * D.SLICE and out.to_pylist() == [json.dumps({"a": "x", "b": i}) for i in range(1000)] + [None]
