import json
import uuid

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from clauselens.functions import vocab as V
from clauselens.operators import prepare as P
from clauselens.operators import resolve as R
from clauselens.operators import responses as S
from clauselens.operators.extract import extract_wide
from clauselens.plans.extraction import answered_contracts, extract_contracts
from clauselens.plans.scoring import classify, score_contracts
from clauselens.sources import contracts as C
from clauselens.sources import derived as D
from clauselens.streaming.stream import contract_stream, extract_stream, write_stream


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_resolve(spark):
    rows = [(1, "currency", v, c, p) for p, (v, c) in enumerate([("EUR", 0.7), ("EUR", 0.9), ("EUR", 0.9)])]
    rows += [(1, "term", "a", 0.9, 0), (1, "term", "b", 0.9, 1), (2, "currency", None, 0.9, 0)]
    frame = spark.createDataFrame(rows, "contract_id long, field string, value string, confidence double, pos int")
    frame = frame.select("*", F.lit(None).cast("string").alias("quote"), F.lit(None).cast("string").alias("note"),
                         F.lit(False).alias("derived"), F.lit("regex").alias("source"))
    got = {r.field: r for r in R.resolve(frame).collect()}
    assert (got["currency"].value, got["currency"].pos) == ("EUR", 1)
    assert got["term"].value is None and "term" in got["term"].warning
    assert len(got) == 2


def test_snippets_against_brute_force(spark):
    lines = [f"line {i}" + (" term here" if i in (3, 9, 10, 70) else "") for i in range(90)]
    lines[8] = "  "
    text = "\n".join(lines)

    def brute(fields):
        hits = [i for i, x in enumerate(lines) if "term" in x] if "contract_term" in fields else []
        chosen = {j for i in hits for j in (i - 1, i, i + 1) if 0 <= j < len(lines)}
        if "internal_entity" in fields:
            chosen |= set(range(60)) | set(range(30, 90))
        blocks, last = [], None
        for i in sorted(chosen):
            if last is None or i != last + 1:
                blocks.append([])
            last = i
            if lines[i].strip():
                blocks[-1].append(f"{i + 1}: {lines[i]}")
        return "\n\n".join("\n".join(b) for b in blocks if b)

    frame = P.with_lines(spark.createDataFrame([(1, text)], "contract_id long, text string"))
    for fields in (["contract_term"], ["contract_term", "internal_entity"]):
        got = R.with_snippets(frame, F.array(*[F.lit(f) for f in fields])).first().snippets
        assert got == brute(fields)
    assert R.with_snippets(frame, F.array(F.lit("indexation"))).first().snippets == text


def test_long_snippets_become_parts(spark):
    text = "\n".join(f"term {i} " + "y" * 50 for i in range(500))
    frame = P.with_lines(spark.createDataFrame([(1, text)], "contract_id long, text string"))
    whole = "\n".join(f"{i + 1}: {x}" for i, x in enumerate(text.split("\n")))
    got = R.with_snippets(frame, F.array(F.lit("contract_term"))).select("snippets", R.in_parts(F.col("snippets")).alias("parts")).first()
    assert got.snippets == whole and "\n".join(got.parts) == whole and len(got.parts) == -(-len(whole) // 12_000)
    assert max(map(len, got.parts)) <= 12_000
    requests = R.extraction_requests(frame, budget=5_000).orderBy("part").collect()
    assert [r.part for r in requests] == list(range(1, requests[0].parts + 1)) and len(requests) > 5
    assert all(len(r.snippets) <= 5_000 and r.snippets in r.prompt for r in requests)
    assert "\n".join(r.snippets for r in requests) == "\n".join(f"{i + 1}: {x}" for i, x in enumerate(text.split("\n")))


def envelope(answer):
    text = answer if isinstance(answer, str) else json.dumps(answer)
    return json.dumps({"choices": [{"message": {"content": text}}]})


def test_one_answer_counts_in_any_order(spark):
    good = envelope({"currency": "EUR", "evidence": {}})
    newer = good.replace("EUR", "CHF")
    rows = [(1, 1, good), (1, 2, newer), (1, 3, good[:30]), (1, 2, newer), (2, 1, "x"), (2, None, None)]
    for part in (rows, rows[::-1]):
        got = S.settled_answers(spark.createDataFrame(part, "contract_id long, attempt int, response string")).collect()
        found = {r.contract_id: [(p.part, p.parts, p.answer.failure, p.answer.fields.currency) for p in r.answers] for r in got}
        assert found[2] == [(1, 1, V.NO_OBJECT, None)]
        assert [(p[:3], p[3].value) for p in found[1]] == [((1, 1, None), "CHF")]


def split_record(spark, *answers):
    """The record of one contract whose request was asked in parts: answers are (part, parts, answer)."""
    contracts = spark.createDataFrame([(1, "Net 30 invoice")], "contract_id long, text string")
    missing = [f for f in V.ROUTED_FIELDS if f != "payment_terms_days"]

    def whole(fields):
        if isinstance(fields, str):
            return fields
        evidence = {f: {"quote": f"about {f}" if f in fields else None, "note": None, "derived": False} for f in missing}
        return {**fields, "evidence": evidence, "warnings": fields.get("warnings", [])}

    rows = [(1, part, parts, envelope(whole(a))) for part, parts, a in answers]
    responses = spark.createDataFrame(rows, "contract_id long, part int, parts int, response string")
    return extract_contracts(contracts, responses).first()


def test_answers_to_parts_are_merged(spark):
    """Two answers that each fill another field: both values stay, each with its own evidence."""
    row = split_record(spark, (2, 2, {"internal_entity": "Alpha", "warnings": ["b"]}), (1, 2, {"currency": "EUR", "warnings": ["a"]}))
    assert (row.currency, row.internal_entity, row.warnings) == ("EUR", "Alpha", ["a", "b"])
    assert (row.evidence.currency.quote, row.evidence.internal_entity.quote) == ("about currency", "about internal_entity")
    # agreement keeps the value, disagreement empties the field with a warning
    row = split_record(spark, *[(i, 3, {"currency": "EUR", "internal_entity": n}) for i, n in ((1, "A"), (2, "B"), (3, "A"))])
    assert (row.currency, row.internal_entity, row.warnings) == ("EUR", None, [V.PART_CONFLICT_WARNING % "internal_entity"])
    # a part that fails, and one that nobody answered
    row = split_record(spark, (1, 4, "sorry"), (2, 4, {"currency": "EUR"}), (3, 4, {"currency": "EUR", "surprise": 1}))
    assert row.currency == "EUR" and row.warnings == [
        V.FAILED_WARNING % V.NO_OBJECT, V.FAILED_WARNING % V.BAD_ANSWER, V.PART_MISSING_WARNING % (1, 4)]
    row = split_record(spark, (1, 2, "sorry"), (2, 2, "no"))
    assert row.currency is None and row.payment_terms_days == 30 and row.warnings == [V.FAILED_WARNING % V.NO_OBJECT]


def test_split_requests_and_their_answers(spark):
    """The parts of a long contract's request, each answered from its own lines."""
    text = "\n".join(["term " + "x" * 200] * 60 + ["Fees in EUR " + "y" * 200] + ["term " + "z" * 200] * 60 + ["renewal: " + "w" * 100])
    contracts = spark.createDataFrame([(1, text)], "contract_id long, text string")
    requests = R.extraction_requests(contracts, budget=8_000).collect()
    assert len(requests) > 2 and {r.parts for r in requests} == {len(requests)}
    rows = []
    for r in requests:
        fields = {"currency": "EUR"} if "EUR" in r.snippets else {"indexation": "none stated"} if "renewal" in r.snippets else {}
        evidence = {f: {"quote": None, "note": None, "derived": False} for f in r.requested if f in V.EVIDENCE_FIELDS}
        rows.append((1, r.part, r.parts, envelope({**fields, "evidence": evidence})))
    responses = spark.createDataFrame(rows, "contract_id long, part int, parts int, response string")
    row = extract_contracts(contracts, responses).first()
    assert (row.currency, row.indexation, row.warnings) == ("EUR", "none stated", [])


def seconds(frame):
    import time

    best = 1e9
    for _ in range(3):
        began = time.time()
        frame.write.format("noop").mode("overwrite").save()
        best = min(best, time.time() - began)
    return best


def test_recovery_among_many_braces(spark):
    frame = spark.createDataFrame([(i, n, "{ " * n + '{"a": 1}' + " }" * n) for i, n in enumerate((4_000, 20_000))], "i int, n int, t string")
    found = frame.withColumn("v", S.recover_object(F.col("t")))
    assert [r[0] for r in found.select(F.try_variant_get("v", "$.a", "int")).collect()] == [1, 1]
    one, five = (seconds(found.where(f"n = {n}")) for n in (4_000, 20_000))
    assert five < 1.5 * one + 0.3


@pytest.mark.parametrize("text, value", [
    ('{"a": 2} {', 2), ('é { {"a": 3}', 3), ('{not {"a": 4}} {"a": 5}', 4), ('{"x": {"a": 6}', 6), ('{"a": 7, "b": "}{"', None),
    ('say "{" then {"a": 8}', 8), ('{"\\u0061": 9}', 9), ('{ "k\\"": {}, "a": 10} tail', 10), ("{}", None), ('{"a": 11}}}}', 11), ("{{}", None),
])
def test_recovered_like_a_decoder(spark, text, value):
    """The first place from which a decoder reads an object, as Python's decoder finds it."""
    def plain():
        for at, ch in enumerate(text):
            if ch == "{":
                try:
                    return json.JSONDecoder().raw_decode(text[at:])[0].get("a")
                except ValueError:
                    pass

    got = spark.createDataFrame([(text,)], "t string").select(F.try_variant_get(S.recover_object(F.col("t")), "$.a", "int")).first()[0]
    assert got == plain() == value


def test_packing_grows_with_the_text(spark):
    frame = spark.range(2).select("id", F.array_join(F.transform(F.sequence(F.lit(1), F.when(F.col("id") == 0, 20_000).otherwise(80_000)), lambda i: F.concat(
        F.lit("line "), i.cast("string"))), "\n").alias("t"))
    parts = frame.select("id", "t", R.in_parts(F.col("t")).alias("parts"))
    for r in parts.collect():
        assert "\n".join(r.parts) == r.t and max(map(len, r.parts)) <= V.REQUEST_CHARS
        assert all(len(a) + 1 + len(b.split("\n")[0]) > V.REQUEST_CHARS for a, b in zip(r.parts, r.parts[1:]))
    assert seconds(parts.where("id = 1")) < 6 * seconds(parts.where("id = 0")) + 0.3
    odd = ["", "\n", "a\n", "\na", "a\n\nb", "x" * 30, "x" * 30 + "\n", "é" * 9 + "\n" + "y" * 30 + "\n\n" + "z"]
    got = spark.createDataFrame([(t,) for t in odd], "t string").select("t", R.in_parts(F.col("t"), 10).alias("p")).collect()
    assert all("\n".join(r.p) == r.t and all(len(p) <= 10 or "\n" not in p for p in r.p) for r in got)


def test_streams_need_a_shared_folder():
    from types import SimpleNamespace

    from clauselens.session import checkpoint_dir

    with pytest.raises(ValueError):
        checkpoint_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default)))


def test_extraction_does_not_repartition(spark, sf):
    plan = extract_wide(D.contracts(spark, sf))._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION" not in plan


@pytest.mark.parametrize("content, parsed, error", [
    ('{"a": 1}', 1, None),
    ('<think>{x}</think>```json\n{"a": 2}\n```', 2, None),
    ('Sure: {"a": 3} bye', 3, None),
    ('{"b": "}", "a": 4}', 4, None),
    ("nothing", None, V.ERR_NO_OBJECT),
    ('{"a": 1', None, V.ERR_UNBALANCED),
    ('{"a": NULL}', None, V.ERR_PARSE),
    (None, None, V.ERR_NULL_CONTENT),
])
def test_first_object(spark, content, parsed, error):
    frame = spark.createDataFrame([(content,)], "c string").select(S.first_object(F.col("c")).alias("x"))
    row = frame.select(F.try_variant_get("x.parsed", "$.a", "int").alias("a"), "x.error").first()
    assert (row.a, row.error) == (parsed, error)


@pytest.mark.parametrize("content, value", [
    ('{"a": 1}', 1), ('text {not} {"a": 2} more {"a": 3}', 2), ('x ```json\n{"a": 4}\n``` {"a": 5}', 4), ("none", None),
])
def test_recover_object(spark, content, value):
    frame = spark.createDataFrame([(content,)], "c string").select(S.recover_object(F.col("c")).alias("v"))
    assert frame.select(F.try_variant_get("v", "$.a", "int")).first()[0] == value


def test_message_shapes(spark):
    parts = [{"type": "text", "text": "a"}, {"text": 5}, "z"]
    raw = [json.dumps({"choices": [{"message": {"content": c}}]}) for c in ("plain", parts)] + ["{}", "broken"]
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "i int, r string")
    got = [r[0] for r in frame.orderBy("i").select(S.message_text(F.col("r"))).collect()]
    assert got == ["plain", "a5z", None, None]


def response_rows(spark, call, *contents):
    return spark.createDataFrame([(i, "m", call, json.dumps(c), 1.0) for i, c in enumerate(contents)],
                                 "contract_id long, model string, call string, content string, elapsed_s double")


def test_risk_answers_are_coerced_or_rejected(spark):
    rows = response_rows(spark, "risk", {"termination_risk": "5.0"}, {"termination_risk": 4.9, "payment_risk": " 2 "},
                         {"counterparty_leverage": "nobody"}, {"data_sensitivity": [1]}, {"payment_risk": 1e30})
    got = S.validate_call(rows, "risk").orderBy("contract_id").collect()
    assert [r.error is None for r in got] == [False, True, True, False, True]
    assert (got[1].termination_risk, got[1].payment_risk, got[1].auto_renewal_risk) == (4, 2, 1)
    assert got[2].counterparty_leverage == "UNCLEAR" and got[4].payment_risk == 5


def test_type_answers_need_their_keys(spark):
    good = {"contract_type_primary": "ANYTHING", "subject_matter": "s", "jurisdiction_city": "Paris", "jurisdiction_country": None,
            "jurisdiction_court_type": None, "contract_language": "English"}
    missing = {k: v for k, v in good.items() if k != "jurisdiction_city"}
    number = {**good, "subject_matter": 5}
    mixed = {**good, "contract_type_secondary": ["a", 1]}
    got = S.validate_call(response_rows(spark, "type", good, missing, number, mixed), "type").orderBy("contract_id").collect()
    assert [r.error is None for r in got] == [True, False, False, False]
    assert got[0].jurisdiction_city is None and got[0].contract_type_secondary == []


def test_local_flow_has_no_shuffle(spark):
    contracts = spark.createDataFrame([(1, "Services agreement\nNet 30 invoice")], "contract_id long, text string")
    record = extract_contracts(contracts)
    assert "Exchange" not in plan(record)
    row = record.first()
    assert (row.primary_contract_type, row.payment_terms_days) == ("SERVICES", 30)
    assert row.warnings == [V.SKIPPED_WARNING] and row.evidence.currency.quote is None


def exchanges(node):
    """Names of the columns that each shuffle of a plan carries."""
    if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        node = node.initialPlan()
    found = []
    if node.getClass().getSimpleName() == "ShuffleExchangeExec":
        out = node.output()
        found.append([out.apply(i).name() for i in range(out.size())])
    children = node.children()
    for i in range(children.size()):
        found += exchanges(children.apply(i))
    return found


def test_flow_shuffles_candidates_not_texts(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        contracts = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").alias("contract_id"), "text")
        answers = contracts.select("contract_id", F.lit("{}").alias("response"))
        text = plan(answered_contracts(contracts, answers))
        # candidates, answers by part (retries are reduced before), answers by contract
        assert text.count("Exchange hashpartitioning(contract_id") == 3
        joined = answered_contracts(contracts, answers)._jdf.queryExecution().executedPlan()
        assert len(exchanges(joined)) >= 3
        for shuffled in exchanges(joined):
            assert not {"text", "lines", "response", "message", "v"} & set(shuffled)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_answers_must_fit_the_request(spark):
    contracts = spark.createDataFrame([(i, "Net 30 invoice") for i in range(4)], "contract_id long, text string")
    missing = [f for f in V.ROUTED_FIELDS if f != "payment_terms_days"]
    item = {"quote": "q", "note": None, "derived": False}
    good = {"currency": "CHF", "auto_renewal": "yes", "renewal_notice_days": 30.0, "evidence": {f: item for f in missing}}
    answers = [good, {**good, "language": "en"}, {**good, "evidence": {}}, {**good, "payment_periodicity": "WEEKLY"}]
    rows = [(i, json.dumps({"choices": [{"message": {"content": json.dumps(a)}}]})) for i, a in enumerate(answers)]
    responses = spark.createDataFrame(rows, "contract_id long, response string")
    got = {r.contract_id: r for r in extract_contracts(contracts, responses).collect()}
    assert (got[0].currency, got[0].auto_renewal, got[0].renewal_notice_days) == ("CHF", True, 30)
    assert got[0].evidence.currency.quote == "q" and got[0].warnings == []
    for i in (1, 2, 3):
        assert got[i].currency is None and got[i].warnings == [V.FAILED_WARNING % "ValidationError"]


def test_files_in_and_out(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name in ("C-01.txt", "C-02.md", "skip.log", "SKIP.MD"):
        (folder / name).write_text("Services agreement\nFees: net 30\n", encoding="utf-8")
    contracts = C.read_contracts(spark, str(folder))
    assert sorted(r.contract_id for r in contracts.collect()) == ["C_01", "C_02"]
    assert C.read_contract(spark, str(folder / "C-01.txt")).first().text.endswith("net 30\n")
    with pytest.raises(Exception):
        C.read_contract(spark, str(folder / "absent.txt")).collect()
    records = extract_contracts(contracts)
    C.write_extractions(records, str(tmp_path / "out"))
    back = C.read_records(spark, str(tmp_path / "out"), records.schema)
    assert sorted(map(str, back.collect())) == sorted(map(str, records.collect()))
    line = next((tmp_path / "out").glob("part-*")).read_text(encoding="utf-8").splitlines()[0]
    assert '"business_unit":null' in line
    pairs = C.fan_out(contracts, ["a", "b"])
    assert pairs.count() == 4


def test_stream_gives_the_batch_result(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(3):
        (folder / f"c-{i}.txt").write_text(f"Lease agreement\nRent: net {10 + i}\n", encoding="utf-8")
    query = write_stream(extract_stream(contract_stream(spark, str(folder))), str(tmp_path / "out"), f"test-{uuid.uuid4()}", available_now=True)
    assert query.awaitTermination(120)
    batch = extract_contracts(C.read_contracts(spark, str(folder)))
    got = C.read_records(spark, str(tmp_path / "out"), batch.schema)
    assert sorted(map(str, got.collect())) == sorted(map(str, batch.collect()))


def test_missing_responses_keep_their_row(spark):
    keys = spark.createDataFrame([(1,)], "contract_id long")
    rows = response_rows(spark, "sector", {"regulated_sectors": ["Energy"]}).filter("contract_id < 0")
    got = classify(keys, ["m"], rows).first()
    assert got.error == S.NO_RESPONSE and got.regulated_sectors == [] and got.elapsed_total_s == 0.0
    assert score_contracts(classify(keys, ["m"], rows)).first().score == 0.38


def test_derived_tables_are_deterministic(spark, sf):
    a = D.contracts(spark, sf).agg(F.sum(F.xxhash64("text").cast("decimal(38,0)"))).first()[0]
    b = D.contracts(spark, sf).repartition(5).agg(F.sum(F.xxhash64("text").cast("decimal(38,0)"))).first()[0]
    assert a == b


def test_retries_of_a_call_give_one_row(spark):
    good = json.dumps({"regulated_sectors": ["Energy"]})
    rows = [(1, "m", "sector", c, 1.0, a) for a, c in ((1, good), (2, good.replace("Energy", "Transport")), (3, None), (4, "{"))]
    for part in (rows, rows[::-1]):
        frame = spark.createDataFrame(part, "contract_id long, model string, call string, content string, elapsed_s double, attempt int")
        got = S.validate_call(frame, "sector").collect()
        assert [(r.regulated_sectors, r.error, r.raw_response) for r in got] == [(["Transport"], None, good.replace("Energy", "Transport"))]


def test_records_shuffle_no_raw_texts(spark, sf):
    people = D.table(spark, sf, "customer").select(F.col("c_custkey").alias("contract_id"))
    responses = D.classification_responses(spark, sf)
    records = classify(people, D.MODELS, responses, texts=False)
    shuffled = exchanges(records._jdf.queryExecution().executedPlan())
    assert shuffled and all(not {"content", "found", "raw", "body"} & set(names) for names in shuffled)
    # the chosen texts come back by their digests; counts of rejected answers come from the same pass
    seen = Observation("rejects")
    whole = S.merge_calls(C.fan_out(people, D.MODELS), responses, observation=seen)
    kept = whole.select("contract_id", "model", "raw_response", "error").collect()
    assert all((r.raw_response is not None) == (r.error is None) for r in kept)
    rejects = {r.call: 0 for r in S.reject_reasons(responses).collect()}
    for r in S.reject_reasons(responses).collect():
        rejects[r.call] += r.responses
    counts = seen.get
    assert {c: counts[f"{c}_rejected"] for c in rejects} == rejects
    assert counts["type_responses"] == responses.where("call = 'type'").count()


def test_partitions_are_replaced(spark, tmp_path):
    rows = spark.createDataFrame([(f"S_{i}", i % 2, None) for i in range(10)], "contract_id string, bucket int, note string")
    for part in (rows, rows.where("bucket = 1"), rows.where("bucket = 1")):
        C.write_records(part, str(tmp_path / "r"), mode="overwrite", partition="bucket")
    back = C.read_records(spark, str(tmp_path / "r"), rows.schema)
    assert sorted(map(str, back.select(rows.columns).collect())) == sorted(map(str, rows.collect()))
    texts = spark.createDataFrame([("a_1", "x\n\ny"), ("b_2", ""), ("c 3", "é\n")], "contract_id string, text string")
    C.write_contracts(texts, str(tmp_path / "t"))
    C.write_contracts(texts.where("contract_id = 'a_1'"), str(tmp_path / "t"))
    got = {r.contract_id: r.text for r in C.read_contract_store(spark, str(tmp_path / "t")).collect()}
    assert got == {"a_1": "x\n\ny", "b_2": "", "c 3": "é\n"}


def test_limits_are_arguments(spark):
    lines = ["Preamble"] * 45 + ["SERVICES AGREEMENT", "Signed for and on behalf of Customer"] + ["-"] * 7 + ["Name: Ann Lee"]
    contracts = spark.createDataFrame([(1, "\n".join(lines))], "contract_id long, text string")
    short = extract_contracts(contracts).first()
    assert (short.primary_contract_type, short.counterparty_signatory) == (None, None)
    long = extract_contracts(contracts, header_lines=60, block_lines=9).first()
    assert (long.primary_contract_type, long.counterparty_signatory) == ("SERVICES", "Ann Lee")
