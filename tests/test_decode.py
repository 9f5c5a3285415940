"""Decode policies on the FIXTURES F5 edge cases."""

import datetime as dt
from decimal import Decimal

from orderstream.operators import decode_json, malformed, split_rows

GOOD = '{"order_id":"a","customer_id":"c","product_id":"p","quantity":3,"price":10.10,"order_timestamp":"2024-01-01T03:04:05.123456","status":"pending"}'

CASES = {
    "good": GOOD,
    "no_fraction": '{"order_id":"b","quantity":1,"price":1,"order_timestamp":"2024-01-01T03:04:05"}',
    "numeric_string": '{"order_id":"c","quantity":"3","price":"1.5"}',
    "fraction_qty": '{"order_id":"d","quantity":2.7}',
    "bad_ts": '{"order_id":"e","order_timestamp":"garbage"}',
    "missing": '{"order_id":"f"}',
    "extra": '{"order_id":"g","quantity":1,"unknown":true}',
    "truncated": '{"order_id":"h",',
    "not_json": "hello",
    "empty": "",
    "array": '[{"order_id":"i"}]',
    "overflow": '{"order_id":"j","quantity":99999999999}',
    "null": None,
    "price_3dp": '{"order_id":"k","price":10.555}',
    "price_big": '{"order_id":"l","price":99999999999.0}',
    "ts_offset": '{"order_id":"m","order_timestamp":"2024-01-01T03:04:05+02:00"}',
}
NAMES = list(CASES)


def _ids(df):
    return {r["offset"]: r for r in df.collect()}


def _by_name(df):
    rows = _ids(df)
    return {NAMES[o]: r for o, r in rows.items()}


def test_drop_malformed(messages):
    df = messages(list(CASES.values()))
    got = _by_name(decode_json(df, "drop_malformed", keep=("offset",)))
    assert set(got) == {"good", "no_fraction", "missing", "extra", "price_3dp"}
    g = got["good"]
    assert g.quantity == 3 and g.price == Decimal("10.10")
    assert g.order_timestamp == dt.datetime(2024, 1, 1, 3, 4, 5, 123456)
    assert got["no_fraction"].order_timestamp == dt.datetime(2024, 1, 1, 3, 4, 5)
    assert got["missing"].quantity is None
    assert got["price_3dp"].price == Decimal("10.56")


def test_null_fields_keeps_records_with_bad_fields(messages):
    df = messages(list(CASES.values()))
    got = _by_name(decode_json(df, "null_fields", keep=("offset",)))
    dropped = {"truncated", "not_json", "empty", "array", "null"}
    assert set(got) == set(NAMES) - dropped
    assert got["numeric_string"].quantity is None and got["numeric_string"].price == Decimal("1.50")
    assert got["bad_ts"].order_timestamp is None and got["bad_ts"].order_id == "e"
    assert got["overflow"].quantity is None
    assert got["price_big"].price is None
    assert got["ts_offset"].order_timestamp is None


def test_permissive_keeps_everything(messages):
    df = messages(list(CASES.values()))
    got = _by_name(decode_json(df, "permissive", keep=("offset",)))
    assert set(got) == set(NAMES)
    assert all(v is None for k, v in got["truncated"].asDict().items() if k != "offset")


def test_fill_missing_only_absent_fields(messages):
    df = messages(list(CASES.values()))
    got = _by_name(decode_json(df, "drop_malformed", keep=("offset",), fill_missing={"quantity": 0, "price": 0}))
    assert got["missing"].quantity == 0 and got["missing"].price == Decimal("0.00")
    assert got["good"].quantity == 3


def test_coerce_numbers(messages):
    df = messages(list(CASES.values()))
    got = _by_name(decode_json(df, "drop_malformed", keep=("offset",), coerce_numbers=True))
    assert got["numeric_string"].quantity == 3 and got["numeric_string"].price == Decimal("1.50")
    assert got["fraction_qty"].quantity == 2
    assert "overflow" not in got and "price_big" not in got
    assert got["price_3dp"].price == Decimal("10.56")


def test_micros_format_requires_six_digits(messages):
    df = messages(list(CASES.values()))
    got = _by_name(decode_json(df, "drop_malformed", keep=("offset",), ts_format="micros"))
    assert "good" in got and "no_fraction" not in got


def test_ms_precision(messages):
    df = messages([GOOD])
    r = decode_json(df, ts_precision="ms").collect()[0]
    assert r.order_timestamp == dt.datetime(2024, 1, 1, 3, 4, 5, 123000)


def test_split_rows(messages):
    two = GOOD + "\n" + GOOD.replace('"a"', '"a2"') + "\n\n"
    df = messages([two, None])
    rows = decode_json(split_rows(df), keep=("offset", "line")).orderBy("line").collect()
    assert [(r.line, r.order_id) for r in rows] == [(0, "a"), (1, "a2")]
    # without splitting, two objects in one message are malformed: neither is lost unseen
    assert decode_json(df).count() == 0
    assert [r.reason for r in malformed(df).filter("message is not null").collect()] == ["malformed_document"]


def test_malformed_reasons(messages):
    df = messages(list(CASES.values()))
    got = {NAMES[r.offset]: r.reason for r in malformed(df, keep=("offset",)).collect()}
    assert got["truncated"] == "malformed_document" and got["null"] == "malformed_document"
    assert got["bad_ts"] == "field_conversion" and got["overflow"] == "field_conversion"
    assert "good" not in got and "missing" not in got


def test_split_rows_separator_is_literal(messages):
    a = '{"order_id":"a"}'
    df = messages([a + "|" + a.replace('"a"', '"b"')])
    rows = decode_json(split_rows(df, sep="|"), keep=("line",)).orderBy("line").collect()
    assert [r.order_id for r in rows] == ["a", "b"]


def test_iso_time_variants(messages):
    ts = ["2024-01-01T03:04:05.123456", "2024-01-01 03:04:05.1", "2024-01-01T03:04:05", "2024-01-01T03:04:05+02:00"]
    df = messages([f'{{"order_id":"x{i}","order_timestamp":"{t}"}}' for i, t in enumerate(ts)])
    got = {r.offset: r.order_timestamp for r in decode_json(df, "null_fields", keep=("offset",)).collect()}
    assert got[0] == dt.datetime(2024, 1, 1, 3, 4, 5, 123456)
    assert got[1] == dt.datetime(2024, 1, 1, 3, 4, 5, 100000)  # space instead of T, one digit
    assert got[2] == dt.datetime(2024, 1, 1, 3, 4, 5)
    assert got[3] is None  # an offset is not a local time


def test_one_document_per_message(messages):
    flat = GOOD
    nested = GOOD.replace('"x"', '"it\'s {x}"') if '"x"' in GOOD else GOOD
    good = [flat, "  " + flat + "\r\n", nested]
    bad = [flat + " garbage", flat + flat, flat + "," + flat, flat + "],[" + flat, flat.replace('"', "'"), "[" + flat + "]", "5", "null", ""]
    df = messages(good + bad)
    assert decode_json(df).count() == len(good)
    assert {r.reason for r in malformed(df).collect()} == {"malformed_document"} and malformed(df).count() == len(bad)


def test_numbers_given_as_strings_must_be_whole(messages):
    import re

    field = re.search(r'"quantity":\s*[^,}]+', GOOD)[0]
    values = ['"3"', "2.7", '"2.7"', '"3d"', '" 4 "', "3e0", "null", "9007199254740993", '"NaN"', "true"]
    texts = [GOOD.replace(field, f'"quantity":{v}') for v in values] + [GOOD.replace(field + ",", "")]
    df = messages(texts)
    got = {r.offset: r.quantity for r in decode_json(df, keep=("offset",), coerce_numbers=True, fill_missing={"quantity": 0}).collect()}
    assert got == {0: 3, 1: 2, 4: 4, 5: 3, 10: 0}  # an explicit null is not an absent number
    filled = decode_json(df, keep=("offset",), coerce_numbers=True, fill_missing={"quantity": 0}, null_numbers="fill")
    assert {r.offset: r.quantity for r in filled.collect()} == {**got, 6: 0}


def test_blank_line_with_a_carriage_return(messages):
    df = split_rows(messages([GOOD + "\r\n\r\n" + GOOD + "\n\t\n"]))
    assert df.count() == 2 and malformed(df).count() == 0
