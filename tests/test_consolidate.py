"""Shapes, keys, linkage and golden records on hand-written messages."""

import json
import random

import pytest
from people import feed, messages, people

from goldweft import schemas as S
from goldweft.functions import payload as P
from goldweft.functions import text as X
from goldweft.operators import classify as C
from goldweft.operators import golden as G
from goldweft.operators import latest as L
from goldweft.operators import rows as R
from goldweft.plans import consolidate as E


def shapes(spark, texts):
    rows = C.classify(feed(spark, texts)).orderBy("seq").collect()
    return [r.shape for r in rows]


PERSON = '{"passport":"1","name":"A","last_name":"B","sex":["M"]'


@pytest.mark.parametrize(
    "data, shape",
    [
        (PERSON + "}", "personal"),
        (PERSON + ',"IBAN":"x","salary":"y"}', "personal"),
        ('{"passport":"1","IBAN":"a","salary":"b"}', "bank"),
        ('{"passport":null,"IBAN":"a","salary":"b"}', "bank"),
        ('{"fullname":"A B","city":"c","address":"d","job":"j"}', "location"),
        ('{"fullname":"A B","city":"c","address":"d","company":"e","job":"j"}', "professional"),
        ('{"fullname":"A B","company":"c"}', "unknown"),
        ('{"fullname":"A","address":"d","IPv4":"1"}', "unknown"),
        ('{"address":"d","IPv4":"1"}', "network"),
        ('{"foo":1}', "unknown"),
        ("{}", "empty"),
        ("{ }", "empty"),
        ("null", "empty"),
        ("[]", "empty"),
        ('""', "empty"),
        ("0", "empty"),
        ("false", "empty"),
        (None, "empty"),
        ("[1]", "non_object"),
        ('"x"', "non_object"),
        ("7", "non_object"),
    ],
)
def test_shape(spark, data, shape):
    assert shapes(spark, [data]) == [shape]


def test_keys_without_content_are_no_keys(spark):
    bank = '{"passport":%s,"IBAN":"a","salary":"b"}'
    refused = [bank % v for v in ("0", "-0.0", "0e5", "false", "[ ]", "{}", "null", '""')]
    refused += ['{"address":0,"IPv4":"a"}', '{"fullname":[],"city":"a","address":"x"}']
    accepted = [bank % v for v in ('"0"', '"false"', '"[]"', "7", "true", "[0]")]
    got = C.classify(feed(spark, refused + accepted))
    keys = [r.link_key for r in got.orderBy("seq").collect()]
    assert keys == [None] * len(refused) + ["0", "false", "[]", "7", "true", "[0]"]
    assert C.missing_key(got).count() == len(refused)


def test_missing_key_is_kept_and_not_counted(spark):
    c = C.classify(feed(spark, ['{"passport":null,"IBAN":"a","salary":"b"}', '{"foo":1}', "{}"]))
    assert C.class_counts(c).first().bank_records == 0
    assert [r.seq for r in C.missing_key(c).collect()] == [0]
    assert sorted(r.seq for r in C.remaining(c).collect()) == [0, 1]


def test_repeated_keys_last_one_wins(spark):
    text = '{"passport":"1","IBAN":"a","salary":"s","IBAN":"b"}'
    latest = L.latest_by_key(C.classify(feed(spark, [text])), "seq")
    assert L.by_passport(latest).first().bank.IBAN == "b"


@pytest.mark.parametrize(
    "raw, key",
    [
        (" Jane Doe ", "jane doe"),
        (" \t\nA  B\x1c", "a  b"),
        ("   ", ""),
        (None, ""),
        ("　X\u0085", "x"),
    ],
)
def test_normalize_key(spark, raw, key):
    df = spark.createDataFrame([(raw,)], "v string")
    assert df.selectExpr(X.normalize_key("v")).first()[0] == key


def test_white_space_is_what_python_strips():
    assert set(X.WHITE_SPACE) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


@pytest.mark.parametrize(
    "value, bulk, strict",
    [
        ('["M","F"]', "M", "M"),
        ("[]", "", None),
        ("Male", "M", "Male"),
        (None, "", None),
        ("", "", None),
        ("[x", "[x", "[x"),
    ],
)
def test_sex_forms(spark, value, bulk, strict):
    df = spark.createDataFrame([(value,)], "v string").selectExpr(
        f"{P.sex_values('v')} AS sex", f"{P.sex_is_scalar('v')} AS sex_is_scalar"
    )
    row = df.selectExpr(P.sex_scalar(mode="bulk"), P.sex_scalar(mode="strict")).first()
    assert (row[0], row[1]) == (bulk, strict)


def test_round_trip_of_ten_people(spark):
    golden = {r["_id"]: r.asDict() for r in E.consolidate(feed(spark, messages()), "seq").collect()}
    assert len(golden) == 10
    for person in people():
        record = golden[person["_id"]]
        assert record["data_sources"] == list(S.SOURCES)
        assert record["uploaded_2_SQL"] is False
        assert {k: record[k] for k in person} == person


def test_input_order_does_not_matter(spark):
    texts = messages() + [m.replace("$", "#") for m in messages() if "IBAN" in m]
    rows = list(enumerate(texts))
    results = []
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "seq bigint, data string").repartition(1 + seed)
        golden = E.consolidate(df, "seq").drop("consolidated_at").collect()
        results.append(sorted(map(str, golden)))
    assert results[0] == results[1] == results[2]
    assert all("#" in r for r in results[0])


def _golden(spark, *docs):
    return E.consolidate(feed(spark, [json.dumps(d) for d in docs]), "seq").collect()


PERSONAL = {"passport": "1", "name": "Ann", "last_name": "Lee", "sex": ["F"]}


def test_whole_record_wins_with_its_nulls(spark):
    rows = _golden(
        spark,
        PERSONAL,
        {"passport": "1", "IBAN": "a", "salary": "b"},
        {"passport": "1", "IBAN": None, "salary": "c"},
    )
    assert (rows[0].IBAN, rows[0].salary) == (None, "c")


def test_blank_fullname_never_links_blank_address_does(spark):
    rows = _golden(
        spark,
        {**PERSONAL, "name": " ", "last_name": " "},
        {**PERSONAL, "passport": "2"},
        {"fullname": "  ", "city": "c", "address": "d"},
        {"fullname": "ann LEE ", "city": "e", "address": None},
        {"address": "   ", "IPv4": "9.9.9.9"},
    )
    found = {r["_id"]: r for r in rows}
    assert found["1"].city is None
    assert (found["2"].city, found["2"].address, found["2"].IPv4) == ("e", None, "9.9.9.9")


def test_namesakes_share_rows(spark):
    rows = _golden(
        spark,
        PERSONAL,
        {**PERSONAL, "passport": "2"},
        {"fullname": "Ann Lee", "city": "c", "address": "d"},
    )
    assert {r.city for r in rows} == {"c"} and len(rows) == 2


def test_incomplete_people_are_unmatched(spark):
    texts = [
        json.dumps({**PERSONAL, "name": ""}),
        json.dumps({"passport": "9", "IBAN": "a", "salary": "b"}),
    ]
    latest = L.latest_by_key(C.classify(feed(spark, texts)), "seq")
    assert sorted(r.key for r in E.unmatched(latest).collect()) == ["1", "9"]
    assert E.golden_of(latest).count() == 0


def test_streets(spark):
    df = spark.createDataFrame(
        [("1", "1 A\nRoad\r", "", "", "\n")],
        "_id string, address string, city string, IPv4 string, `company address` string",
    )
    rows = {r.type: r for r in R.address_union(df).collect()}
    assert rows["Home"].street_name == "1 A Road"
    assert rows["Work"].street_name == "" and rows["Work"].city == ""


def test_strict_city_default(spark):
    df = spark.createDataFrame(
        [("1", "1 A", None, None, "2 B")],
        "_id string, address string, city string, IPv4 string, `company address` string",
    )
    rows = R.address_union(df, "strict").collect()
    assert [(r.type, r.city, r.ip_address) for r in rows] == [("Home", "Unknown", "0.0.0.0")]


def test_upload_filter_takes_null(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, uploaded_2_SQL boolean")
    assert sorted(r.id for r in df.filter(G.not_uploaded()).collect()) == [2, 3]
