"""Literal cases of the scalar rules."""

import hashlib
import random
import string

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sheetloom.functions import (
    blank_to_null,
    canonical_header,
    clean_email,
    clean_mobile,
    clean_text,
    client_status,
    datetime_text,
    double_text,
    header_key,
    is_tick_text,
    normalize_datetime,
    normalize_headers,
    record_id,
    safe_double,
    safe_integer,
    snake_case,
    spreadsheet_id,
    strip,
    title_case,
    to_bool,
    with_datetime,
)

PIVOT = 2075


def test_normalize_headers(evaluate):
    cases = {
        (" Email  Address ", "Amount", "Amount", "", "₹"): ["email_address", "amount", "amount_2", "column_4", "column_5"],
        ("a", "a", "a"): ["a", "a_2", "a_3"],
        ("a", "a", "a_2"): ["a", "a_2", "a_2_2"],
        (): [],
    }
    assert evaluate(normalize_headers, [list(k) for k in cases], "array<string>") == list(cases.values())


def test_numbers_like_pandas(evaluate):
    texts = [" 499 ", "1,000", "1e3", "1d", "0x1A", "41.0", "30.5", "abc", "", None, ".5", "5.", "-5", "+5", "--5", "1_000"]
    texts += ["nan", "inf", "-Infinity", "1e400", "1e-400", "٣", "\xa05", "\t5\n", "5\x1c", "9223372036854775807", "1.5e-3", "e5"]
    want = [None if pd.isna(x) else float(x) for t in texts for x in pd.to_numeric(pd.Series([t], dtype=object), errors="coerce")]
    assert evaluate(safe_double, texts) == want
    whole = [None if x is None or x % 1 else int(x) for x in want]
    whole[texts.index("9223372036854775807")] = 9223372036854775807
    assert evaluate(safe_integer, texts) == whole
    assert evaluate(safe_double, ["true", "false"]) == [1.0, 0.0]


def test_double_text_like_python(evaluate):
    values = [499.0, 0.0, -0.0, 1e7, 12345678.5, 1e15, 1e16, 1.5e20, 1e-5, 0.0001, 0.00012, -1e7, 123456789.25, 0.1, 1e-7]
    assert evaluate(double_text, values, "double") == [repr(v) for v in values]
    assert evaluate(double_text, [float("nan"), float("inf"), None], "double") == [None, "inf", None]


# text = stamp: numbers are days, seconds, milli-, micro- or nanoseconds by their size, texts are day first
STAMPS = """
45321.5 = 2024-01-30 12:00:00.000000
45321 = 2024-01-30 00:00:00.000000
60.25 = 1900-02-28 06:00:00.000000
-1.5 = 1899-12-28 12:00:00.000000
0 = 1899-12-30 00:00:00.000000
120000 = 2228-07-18 00:00:00.000000
150000 = none
-81000 = 1678-03-23 00:00:00.000000
-82000 = none
99999999 = none
20240115 = none
1706616000 = 2024-01-30 12:00:00.000000
1706616000000 = 2024-01-30 12:00:00.000000
1706616000000000 = 2024-01-30 12:00:00.000000
1706616000000000000 = 2024-01-30 12:00:00.000000
1706616000.1 = 2024-01-30 12:00:00.099999
1706616000123.4 = 2024-01-30 12:00:00.123399
-86400.5 = none
1706616000123456789 = 2024-01-30 12:00:00.123456
9223372036 = 2262-04-11 23:47:16.000000
9223372037 = none
9223372036854775 = 2262-04-11 23:47:16.854775
1e9 = 2001-09-09 01:46:40.000000
1.706616e18 = 2024-01-30 12:00:00.000000
05/03/2024 = 2024-03-05 00:00:00.000000
13/05/2024 = 2024-05-13 00:00:00.000000
05/13/2024 = 2024-05-13 00:00:00.000000
2024-03-05 = 2024-03-05 00:00:00.000000
2024/03/05 = 2024-03-05 00:00:00.000000
2024/13/05 = 2024-05-13 00:00:00.000000
junk = none
5-3-2024 = 2024-03-05 00:00:00.000000
5.3.2024 10:30 = 2024-03-05 10:30:00.000000
05 03 2024 = 2024-03-05 00:00:00.000000
05-03-24 = 2024-03-05 00:00:00.000000
24-03-05 = 2005-03-24 00:00:00.000000
99-01-02 = 1999-02-01 00:00:00.000000
10-11-12 = 2012-11-10 00:00:00.000000
32/1/05 = 2032-05-01 00:00:00.000000
40-5-20 = 2040-05-20 00:00:00.000000
5 Mar 2024 = 2024-03-05 00:00:00.000000
5-Mar-24 = 2024-03-05 00:00:00.000000
5Mar2024 = 2024-03-05 00:00:00.000000
5th March 2024 = 2024-03-05 00:00:00.000000
March 5, 2024 = 2024-03-05 00:00:00.000000
Mar 5 24 = 2024-03-05 00:00:00.000000
2024 Mar 5 = 2024-03-05 00:00:00.000000
2024-03 = 2024-03-01 00:00:00.000000
03/2024 = 2024-03-01 00:00:00.000000
Mar 2024 = 2024-03-01 00:00:00.000000
2024 March = 2024-03-01 00:00:00.000000
Mar-24 = none
5 Mar = none
Tue, 5 Mar 2024 = 2024-03-05 00:00:00.000000
Tue Mar 5 10:30:00 2024 = 2024-03-05 10:30:00.000000
05/03/2024 10:30PM = 2024-03-05 22:30:00.000000
05/03/2024 12:30 am = 2024-03-05 00:30:00.000000
05/03/2024, 10:30:00 = 2024-03-05 10:30:00.000000
05/03/2024 13:30 PM = none
2024-03-05T10:30:00Z = 2024-03-05 10:30:00.000000
2024-03-05T10:30:00+05:30 = 2024-03-05 10:30:00.000000
2024-03-05 10:30:00 IST = 2024-05-03 10:30:00.000000
2024-03-05 10:30 PM = 2024-05-03 22:30:00.000000
2024-03-05, 10:30 = 2024-05-03 10:30:00.000000
10:30 2024-03-05 = 2024-05-03 10:30:00.000000
2024-03-05 24:00 = none
2024-03-05 10:60 = none
30/02/2024 = none
00/01/2024 = none
5/3/224 = none
1677-09-21 = none
1677-09-22 = 1677-09-22 00:00:00.000000
2262-04-11 = 2262-04-11 00:00:00.000000
2262-04-12 = none
20240305T103000 = 2024-03-05 10:30:00.000000
20240305 10:30 = 2024-03-05 10:30:00.000000
5/3/2024 10:30:99 = none
5/3/2024 0 PM = 2024-03-05 12:00:00.000000
2024-03-05T103000 = 2024-03-05 10:30:00.000000
2024-03-05T10 = 2024-03-05 10:00:00.000000
5 of March 2024 = 2024-03-05 00:00:00.000000
Sept 5, 2024 = 2024-09-05 00:00:00.000000
5 Foo 2024 = none
499 INR = none
1,000 = none
Q1 2024 = none
"""
FIXED_DATES = dict(line.split(" = ") for line in STAMPS.strip().splitlines())
FIXED_DATES = {text: None if stamp == "none" else stamp for text, stamp in FIXED_DATES.items()}


def made_up_dates(n: int) -> list[str]:
    pick = random.Random(7)
    made = []
    for _ in range(n):
        y, m, d = pick.choice([2024, 2019, 1999, 2031]), pick.randint(1, 13), pick.randint(1, 31)
        mon = pick.choice(["Jan", "Feb", "march", "APR", "May", "Sept", "December"])
        s = pick.choice("/-. ")
        date = pick.choice(
            [f"{d}{s}{m}{s}{y}", f"{d:02d}{s}{m:02d}{s}{y}", f"{y}{s}{m:02d}{s}{d:02d}", f"{d} {mon} {y}", f"{mon} {d}, {y}", f"{d}{s}{mon}{s}{y % 100:02d}"]
        )
        h, mi = pick.randint(0, 24), pick.randint(0, 60)
        clock = pick.choice(["", "", f" {h:02d}:{mi:02d}", f" {h}:{mi:02d}:07", f", {h}:{mi:02d} PM", f" {h} am", f"T{h:02d}:{mi:02d}:09.123456"])
        made.append(date + clock)
    return made


def test_datetime_column_like_pandas(spark):
    made = list(dict.fromkeys(made_up_dates(400)))
    day_first = pd.to_datetime(pd.Series(made, dtype=object), format="mixed", dayfirst=True, errors="coerce")
    want = FIXED_DATES | {t: None if pd.isna(d) else d.strftime("%Y-%m-%d %H:%M:%S.%f") for t, d in zip(made, day_first)}
    texts = list(want)
    rows = spark.createDataFrame([(t,) for t in texts], "v string").withColumn("w", F.col("v"))
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        decoded = with_datetime(rows, "w", PIVOT).select("v", datetime_text(F.col("w")).alias("t"))
        got = dict(decoded.collect())
        assert {t: got[t] for t in texts} == want
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_datetime_expression_equals_column_form(evaluate):
    got = evaluate(lambda c: datetime_text(normalize_datetime(c, PIVOT)), list(FIXED_DATES))
    assert got == list(FIXED_DATES.values())


def test_wall_clock_survives_daylight_saving(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    rows = spark.createDataFrame([("2024-03-10 02:30:00",)], "v string")
    assert with_datetime(rows, "v").select(datetime_text(F.col("v"))).first()[0] == "2024-03-10 02:30:00.000000"
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_datetime_text(spark):
    row = spark.sql("select timestamp_ntz'2024-03-05 10:11:12.1' a, timestamp_ntz'2024-03-05 10:11:12' b, cast(null as timestamp_ntz) c")
    got = row.select(*(datetime_text(F.col(c)) for c in "abc")).first()
    assert tuple(got) == ("2024-03-05 10:11:12.100000", "2024-03-05 10:11:12.000000", None)


def test_record_id(spark):
    rows = spark.sql("select 'A@B.C' e, '1' m, timestamp_ntz'2024-03-05 00:00:00.5' d union all select null, null, null")
    got = {r[0] for r in rows.select(record_id(F.col("e"), F.col("m"), F.col("d"))).collect()}
    want = {hashlib.sha256(t.encode()).hexdigest() for t in ("a@b.c|1|2024-03-05 00:00:00", "<na>|<NA>|")}
    assert got == want
    assert "f32729cdc0bbf991f7e01eb03a7b67a0a4ff6d37b57ac09a29fff4de2293f24d" in got


def test_whitespace_like_python(evaluate):
    pick = random.Random(3)
    odd = "\t\n\x0b\x0c\r\x1c\x1f \x85\xa0    　"
    texts = ["".join(pick.choice("ab  " + odd) for _ in range(pick.randint(0, 8))) for _ in range(300)]
    assert evaluate(strip, texts) == [t.strip() for t in texts]
    assert evaluate(blank_to_null, texts) == [t if t.strip() else None for t in texts]
    assert evaluate(clean_text, texts) == [" ".join(t.split()) for t in texts]
    assert evaluate(clean_text, [None]) == [""]


def test_title_case_like_python(evaluate):
    pick = random.Random(4)
    letters = string.ascii_letters + "éÀñ -'._0123#हि"
    texts = ["mary-jane o'neil", "d2c BOB", ""] + ["".join(pick.choice(letters) for _ in range(12)) for _ in range(300)]
    assert evaluate(title_case, texts) == [t.title() for t in texts]


@pytest.mark.parametrize(
    "function, cases",
    [
        (header_key, {"PH NO.": "ph no", "ACCESS - GOLD": "access gold", "₹": ""}),
        (snake_case, {"PH NO.": "ph_no", " Agra  Event ": "agra_event"}),
        (clean_email, {"A B@X.com": "ab@x.com"}),
        (clean_mobile, {"+91 (98) 76-5": "+9198765", "٣x": "٣"}),
        (to_bool, {"TRUE": True, " Yes ": True, "1": True, "☑": True, "no": False, "": False, None: False, "maybe": False}),
        (is_tick_text, {"TRUE": True, "☐": True, "0": True, "x": False, "": False}),
        (
            spreadsheet_id,
            {"https://h/spreadsheets/d/a-B_1/edit#gid=0": "a-B_1", "  raw ": "raw", "https://h/d/x": "https://h/d/x"},
        ),
        (
            canonical_header,
            {
                "PH NO.": "mobile",
                "Coach Name": "coach",
                "Status Data": "status_data",
                "GOLD LIFE TIME": "access_gold_pro_lifetime",
                "Agra": None,
                "₹": None,
                "Photo": "mobile",
                "MAIL": "email",
                "Username": None,
                "Golden": None,
                "Tech": "tech_member",
                "Remarks": "comment",
            },
        ),
    ],
)
def test_text_rules(evaluate, function, cases):
    assert dict(zip(cases, evaluate(function, list(cases)))) == cases


def test_client_status(spark):
    cases = {("Refunded", "DEACTIVATED"): "Deactivated", ("refund", ""): "Refund", ("", ""): "Active", ("x", "MAIN"): "Active"}
    rows = spark.createDataFrame(list(cases), "s string, t string")
    got = rows.select("s", "t", client_status(F.col("s"), F.col("t")).alias("c")).collect()
    assert {(r.s, r.t): r.c for r in got} == cases
