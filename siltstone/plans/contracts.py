"""Queries that judge structured replies. Their SQL reads the same JSON by rules of its own."""

from __future__ import annotations

from pyspark.sql import functions as F

from siltstone import schemas as S
from siltstone.operators import records
from siltstone.plans import inputs as I

QUERIES, ORACLE_SQL = {}, {}

#: Rules of the SQL side: (field, kind, argument).
_RULES = {
    "material": [("name", "given"), ("component", "word?", S.COMPONENTS)],
    "fact": [("material", "object", "material"), ("property", "filled"), ("conditions", "entries"), ("category", "word", S.FACT_CATEGORIES), ("polarity", "word=", S.POLARITIES), ("triple", "triple"), ("evidence_sentence", "filled")],
    "comparison": [("baseline", "filled"), ("modification", "filled"), ("metric", "filled"), ("direction", "word", S.DIRECTIONS), ("conditions", "entries"), ("component", "word?", S.COMPONENTS), ("evidence_sentence", "filled")],
    "chunk_extraction": [("chunk_index", "given"), ("facts", "objects", "fact"), ("comparisons", "objects", "comparison")],
    "extraction_batch": [("results", "objects", "chunk_extraction")],
    "claim_pair": [("sentence_1", "filled"), ("sentence_2", "filled"), ("category", "word", S.PAIR_CATEGORIES), ("subset_name", "word", S.PAIR_SUBSETS)],
    "chunk_pairs": [("chunk_index", "given"), ("pairs", "objects", "claim_pair")],
    "claim_batch": [("results", "objects", "chunk_pairs")],
    "qa_item": [("question", "filled"), ("answer", "filled"), ("reasoning", "filled"), ("question_type", "word", S.QUESTION_TYPES), ("answer_type", "word", S.ANSWER_TYPES), ("component", "word?", S.COMPONENTS)],
    "qa_generation": [("items", "objects", "qa_item")],
    "dpo_rejection": [("rejected", "filled"), ("error_type", "word", S.DPO_ERRORS)],
    "idea": [("hypothesis", "filled"), ("mechanism", "filled"), ("risks", "filled"), ("validation_experiments", "texts"), ("success_metrics", "texts")],
    "ideation": [("problem", "filled"), ("constraints", "texts"), ("reasoning", "filled"), ("ideas", "objects", "idea")],
    "qa_judge": [("faithfulness", "score"), ("correctness", "score"), ("specificity", "score"), ("rationale", "said")],
    "ideation_judge": [("groundedness", "score"), ("correctness", "score"), ("novelty", "score"), ("feasibility", "score"), ("rationale", "said")],
    "open_judge": [("correct", "given"), ("score", "score"), ("rationale", "said")],
    "negative_judge": [("caught_flaw", "given"), ("rationale", "said")],
}


def _error(contract: str, j: str, depth: int = 0) -> str:
    """SQL: the first rule that the JSON value j breaks, null if none."""
    arms = []
    for field, kind, *more in _RULES[contract]:
        text, there = f"({j}->>'$.{field}')", f"json_exists({j}, '$.{field}')"
        words = f"({', '.join(repr(w) for w in more[0])})" if kind.startswith("word") else ""
        bad, message = {
            "filled": (f"trim(coalesce({text}, '')) = ''", "blank"), "given": (f"{text} IS NULL", "missing"), "object": (f"{text} IS NULL", "missing"),
            "word": (f"coalesce({text}, '') NOT IN {words}", "not an allowed value"), "word?": (f"{text} IS NOT NULL AND {text} NOT IN {words}", "not an allowed value"),
            "word=": (f"{there} AND coalesce({text}, '') NOT IN {words}", "not an allowed value"), "score": (f"coalesce(try_cast({text} AS INT), 0) NOT BETWEEN 1 AND 5", "not from 1 to 5"),
            "said": (f"{there} AND {text} IS NULL", "null"), "triple": (f"{there} AND ({text} IS NULL OR json_array_length({j}, '$.{field}') NOT IN (0, 3))", "three elements or none"),
            "texts": (f"{there} AND ({text} IS NULL OR list_contains(json_extract({j}, '$.{field}[*]')::VARCHAR[], 'null'))", "not a list of texts"),
            "entries": (f"{there} AND {text} IS NULL", "not a map of texts"), "objects": (f"{there} AND {text} IS NULL", "not a list"),
        }[kind]
        arms.append(f"CASE WHEN {bad} THEN '{field}: {message}' END")
        if kind == "object":
            arms.append(f"'{field}: ' || {_error(more[0], f'({j}->{repr("$." + field)})', depth)}")
        if kind == "objects":
            x = f"x{depth}"
            arms.append(f"'{field}: ' || list_filter(list_transform(json_extract({j}, '$.{field}[*]'), lambda {x}: {_error(more[0], x, depth + 1)}), lambda e: e IS NOT NULL)[1]")
    return f"coalesce({', '.join(arms)}, NULL)"


def _register(name: str, contract: str, *replies: str, parsed: str | None = None, parsed_sql: str = "") -> None:
    """A query over conversations: each turn gets one of the replies. parsed: a field of valid replies to return too, and its SQL over j."""
    n, listed = len(replies), ", ".join("'" + r.replace("'", "''") + "'" for r in replies)
    keys = ", ".join(repr(f) for f, *_ in _RULES[contract])
    optional = {"material": ", 'formula', 'class'", "fact": ", 'value', 'unit'", "comparison": ", 'magnitude'", "qa_item": ", 'chemistry'"}.get(contract, "")
    value = f", CASE WHEN error IS NULL THEN {parsed_sql} END AS value" if parsed else ""
    ORACLE_SQL[name] = f"""WITH r AS (SELECT conv_id, turn, regexp_extract(([{listed}])[(conv_id * 100 + turn) % {n} + 1], '(?s)\\{{.*\\}}') AS raw FROM conversations),
        p AS (SELECT *, CASE WHEN json_valid(raw) THEN raw::JSON END AS j FROM r),
        e AS (SELECT conv_id, turn, j, CASE WHEN j IS NULL THEN 'not JSON' WHEN len(json_keys(j)) > 0 AND NOT list_has_any(json_keys(j), [{keys}{optional}]) THEN 'no field of the schema' ELSE {_error(contract, 'j')} END AS error FROM p)
        SELECT conv_id, turn, error IS NULL AS valid, error{value} FROM e"""

    def run(spark, d):
        k = ((F.col("conv_id") * 100 + F.col("turn")) % n).cast("int")
        rows = I.table(spark, d, "conversations").select("conv_id", "turn", F.get(F.array(*map(F.lit, replies)), k).alias("reply"))
        out = records.validate(rows, "reply", contract)
        return out.select("conv_id", "turn", "valid", "error", *([F.when(F.col("valid"), F.expr(parsed)).alias("value")] if parsed else []))

    QUERIES[name] = run


_M = '"material": {"name": "NMC", "class": "oxide"}'
_F = '{%s, "property": "%s", "category": "%s", "evidence_sentence": " seen ", %s}'
_GOOD_FACT = _F % (_M, " capacity ", "thermal", '"triple": ["a", "b", "c"], "conditions": {"T": "25"}')
_register("validate_material", "material", 'Here it is:\n```json\n{"name": "LFP", "component": "cathode"}\n```', '{"name": "LFP"} trailing words', '{"first": 1, "second": 2}', "{not json}", "nothing", '{"name": "x", "component": "wheel"}', '{"name": null}', '{"class": "oxide", "name": ""}')
_register("validate_fact", "fact", _GOOD_FACT, _F % (_M, "capacity", "odd", '"triple": []'), _F % (_M, "capacity", "thermal", '"triple": ["a"]'), _F % (_M, "  ", "thermal", '"unit": "mV"'), "no reply", '{"other": 1}',
          _F % ('"material": {"name": "x", "component": "wheel"}', "p", "thermal", '"unit": null'), _F % (_M, "p", "thermal", '"polarity": null'), _F % (_M, "p", "thermal", '"polarity": "negative"'),
          '{"property": "p", "category": "thermal", "evidence_sentence": "s"}', _F % (_M, "p", "cost_safety", '"triple": null'), _F % (_M, "p", "thermal", '"conditions": null'),
          parsed="concat_ws('|', parsed.property, parsed.polarity, cast(size(parsed.triple) AS string), parsed.evidence_sentence, parsed.material.name)",
          parsed_sql="concat_ws('|', trim(j->>'$.property'), coalesce(j->>'$.polarity', 'positive'), coalesce(json_array_length(j, '$.triple'), 0)::VARCHAR, trim(j->>'$.evidence_sentence'), j->>'$.material.name')")
_C = '{"baseline": "%s", "modification": "m", "metric": "x", "direction": "%s", "evidence_sentence": "%s"%s}'
_register("validate_comparison", "comparison", _C % ("b", "improves", "s", ""), _C % ("", "improves", "s", ""), _C % ("b", "doubles", "s", ""), _C % ("b", "worsens", " ", ""), _C % ("b", "unchanged", "s", ', "component": "wheel"'), _C % ("b", "unchanged", "s", ', "component": null'), '{"baseline": "b"', "{}")
_B = '{"results": [%s]}'
_register("validate_extraction", "extraction_batch", _B % f'{{"chunk_index": 0, "facts": [{_GOOD_FACT}], "comparisons": []}}', "{}", '{"": "results"}', _B % '{"facts": []}', _B % '{"chunk_index": 1, "facts": [{"property": "x"}]}',
          _B % f'{{"chunk_index": 0}}, {{"chunk_index": 1, "facts": [{_GOOD_FACT}, {_F % (_M, "p", "odd", chr(34) + "unit" + chr(34) + ": null")}]}}', _B % f'{{"chunk_index": 2, "comparisons": [{_C % ("b", "improves", "s", ", " + chr(34) + "component" + chr(34) + ": " + chr(34) + "wheel" + chr(34))}]}}',
          '{"results": null}', _B % '{"chunk_index": 3, "facts": null}', _B % f'{{"chunk_index": 4, "facts": [{_F % (_M, "p", "thermal", chr(34) + "polarity" + chr(34) + ": null")}]}}',
          parsed="cast(size(flatten(transform(parsed.results, r -> r.facts))) AS string)", parsed_sql="len(json_extract(j, '$.results[*].facts[*]'))::VARCHAR")
_P = '{"sentence_1": "%s", "sentence_2": "b", "category": "%s", "subset_name": "%s"}'
_register("validate_claim_pair", "claim_pair", _P % ("a", "contradiction", "numeric"), _P % ("a", "paraphrase", "swap"), _P % (" ", "paraphrase", "swap"), _P % ("a", "same", "swap"), _P % ("a", "paraphrase", "other"), "{}")
_register("validate_claims", "claim_batch", _B % f'{{"chunk_index": 0, "pairs": [{_P % ("a", "contradiction", "numeric")}]}}', _B % '{"chunk_index": 0}', _B % '{"pairs": []}', _B % f'{{"chunk_index": 0, "pairs": [{_P % ("a", "paraphrase", "entity")}, {_P % ("a", "paraphrase", "odd")}]}}', '{"results": []}', '{"pairs": []}')
_Q = '{"question": "%s", "answer": "a", "reasoning": "r", "question_type": "%s", "answer_type": "OPEN"%s}'
_register("validate_qa", "qa_item", _Q % ("q", "mechanism", ""), _Q % (" ", "mechanism", ""), _Q % ("q", "riddle", ""), "{}", _Q % ("q", "other", ', "component": "anode"'), _Q % ("q", "other", ', "component": "wheel"'))
_register("validate_generation", "qa_generation", '{"items": [%s, %s]}' % (_Q % ("q", "mechanism", ""), _Q % ("p", "trade_off", "")), '{"items": [%s]}' % (_Q % ("q", "other", ', "component": "wheel"')), '{"items": []}', '{"items": [{}]}', "{}", '{"item": []}')
_register("validate_rejection", "dpo_rejection", '{"rejected": " wrong ", "error_type": "overclaiming"}', '{"rejected": "", "error_type": "overclaiming"}', '{"rejected": "w", "error_type": "typo"}', '{"rejected": "w"}', parsed="parsed.rejected", parsed_sql="trim(j->>'$.rejected')")
_I = '{"hypothesis": "h", "mechanism": "%s", "risks": "r"%s}'
_register("validate_ideation", "ideation", '{"problem": "p", "reasoning": "r", "ideas": [%s]}' % (_I % ("m", ', "success_metrics": ["x"]')), '{"problem": "p", "reasoning": "r"}', '{"problem": " ", "reasoning": "r"}', '{"problem": "p", "reasoning": "r", "constraints": null}',
          '{"problem": "p", "reasoning": "r", "ideas": [%s, %s]}' % (_I % ("m", ""), _I % (" ", "")), '{"problem": "p", "reasoning": "r", "ideas": [%s]}' % (_I % ("m", ', "success_metrics": ["x", null]')), '{"problem": "p", "reasoning": "r", "constraints": ["c", null]}',
          parsed="cast(size(parsed.ideas) AS string)", parsed_sql="coalesce(json_array_length(j, '$.ideas'), 0)::VARCHAR")
_J = '{"faithfulness": %s, "correctness": 5, "specificity": %s, "rationale": %s}'
_register("validate_judge", "qa_judge", _J % (4, 3, '"fine"'), _J % (0, 3, '"fine"'), _J % (4, 6, '"fine"'), '{"faithfulness": 4,', _J % (4, 3, "null"), '{"faithfulness": 1, "correctness": 2, "specificity": 3}', _J % ("null", 3, '""'))
_register("validate_ideation_judge", "ideation_judge", '{"groundedness": 1, "correctness": 2, "novelty": 3, "feasibility": 4}', '{"groundedness": 1, "correctness": 2, "novelty": 3}', '{"groundedness": 1, "correctness": 2, "novelty": 9, "feasibility": 4}', "{}")
_register("validate_open_judge", "open_judge", '{"correct": true, "score": 5, "rationale": ""}', '{"correct": false, "score": 1}', '{"score": 3}', '{"correct": true, "score": 0}', '{"correct": null, "score": 2}')
_register("validate_negative_judge", "negative_judge", '{"caught_flaw": true}', '{"caught_flaw": false, "rationale": "r"}', '{"rationale": "r"}', '{"caught_flaw": null}', '{"found": true}')


def _ideas(spark, d):
    k = (F.col("conv_id") * 100 + F.col("turn")) % 3
    reply = F.when(k == 0, '{"problem": " p ", "reasoning": "r", "constraints": ["c"], "ideas": [%s]}' % (_I % ("m", ""))).when(k == 1, '{"problem": "p", "reasoning": "r"}').otherwise('{"problem": "p"}')
    rows = I.table(spark, d, "conversations").select(F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("chunk_id"), F.col("conv_id").alias("doc_id"), reply.alias("reply"))
    return records.ideations(records.validate(rows, "reply", "ideation")).select("id", "problem", F.array_join("constraints", ",").alias("constraints"), F.col("ideas")[0]["hypothesis"].alias("hypothesis"))


QUERIES["idea_records"] = _ideas
ORACLE_SQL["idea_records"] = "SELECT conv_id || '-' || turn || '#idea' AS id, 'p' AS problem, 'c' AS constraints, 'h' AS hypothesis FROM conversations WHERE (conv_id * 100 + turn) % 3 = 0"
