import json

import pytest
from pyspark.sql import functions as F

from indicatrix.operators import contract
from tests.conftest import rows

GOOD = {"id": "1", "domain": "a.com", "tld": None, "event_ts": "2024-01-01T00:00:00Z", "source": "s", "producer_ts": "2024-01-01T00:00:00Z"}
NOW = F.lit("2024-01-01 00:00:01.25").cast("timestamp")


def without(key):
    return {k: v for k, v in GOOD.items() if k != key}


CASES = [
    (json.dumps(GOOD), None),
    (json.dumps({**GOOD, "extra": {"a": [1]}}), None),
    (json.dumps({**GOOD, "tld": "com"}), None),
    (json.dumps(without("tld")), None),
    (json.dumps({**GOOD, "event_ts": "not a date"}), None),
    ("{broken", "json_decode_error"),
    ("", "json_decode_error"),
    (None, "json_decode_error"),
    ("[1, 2]", "contract_violation:<root>"),
    ("7", "contract_violation:<root>"),
    ('"text"', "contract_violation:<root>"),
    ("null", "contract_violation:<root>"),
    (json.dumps(without("id")), "contract_violation:<root>:'id' is a required property"),
    (json.dumps(without("producer_ts")), "contract_violation:<root>:'producer_ts' is a required property"),
    (json.dumps({**without("source"), "id": 5}), "contract_violation:<root>:'source' is a required property"),
    (json.dumps({**GOOD, "id": None}), "contract_violation:id:null is not of type 'string'"),
    (json.dumps({**GOOD, "id": 5, "domain": 6}), "contract_violation:id:5 is not of type 'string'"),
    (json.dumps({**GOOD, "id": ""}), "contract_violation:id:'' should be non-empty"),
    (json.dumps({**GOOD, "tld": 9}), "contract_violation:tld:9 is not of type 'string', 'null'"),
    (json.dumps({**GOOD, "event_ts": ["x"]}), "contract_violation:event_ts"),
    (json.dumps({**GOOD, "source": ""}), "contract_violation:source"),
]


@pytest.mark.parametrize("partitions", [1, 3])
def test_first_broken_rule(table, partitions):
    df = table([(i, v) for i, (v, _) in enumerate(CASES)], "i int, value string").repartition(partitions)
    got = {r["i"]: r["reason"] for r in contract.validate(df).collect()}
    for i, (value, want) in enumerate(CASES):
        if want is None:
            assert got[i] is None, value
        else:
            assert got[i] is not None and got[i].startswith(want), (value, got[i])


def test_parse_sends_everything_but_objects_to_the_dead_letters(table):
    texts = [json.dumps(GOOD), "{broken", "", None, "[1]", "7", "{}"]
    parsed = contract.parse(table([(t,) for t in texts], "value string"))
    good, bad = contract.good_events(parsed, NOW), contract.bad_events(parsed, NOW)
    assert good.count() == 2
    assert rows(bad, "value", "reason") == sorted(
        [(t, "json_parse_failed") for t in ["{broken", "", None, "[1]", "7"]], key=lambda r: (r[0] is not None, str(r[0]))
    )
    event = good.filter("id = '1'").first()
    assert event["latency_sec"] == 1.25 and event["tld"] is None


def test_bad_times_become_null(table):
    parsed = contract.parse(table([(json.dumps({**GOOD, "event_ts": "junk"}),)], "value string"))
    row = contract.good_events(parsed, NOW).first()
    assert row["event_ts"] is None and row["latency_sec"] is None


def test_rules_come_from_the_contract(table):
    other = {"type": "object", "required": ["n"], "properties": {"n": {"type": "integer"}, "s": {"type": "string", "minLength": 3}}}
    texts = ['{"n":1,"s":"abc"}', '{"n":"1"}', '{"n":1,"s":"ab"}', '{"s":"abc"}']
    got = contract.validate(table([(i, t) for i, t in enumerate(texts)], "i int, value string"), other)
    reasons = [r["reason"] for r in got.orderBy("i").collect()]
    assert reasons[0] is None
    assert [r.rsplit(":", 1)[0] for r in reasons[1:]] == ["contract_violation:n", "contract_violation:s", "contract_violation:<root>"]


def test_no_python_in_the_plan(table):
    plan = contract.validate(table([("{}",)], "value string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
