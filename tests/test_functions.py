import difflib
import random

import pytest
from pyspark.sql import functions as F

from goldpan.functions import contact as C
from goldpan.functions import dates as D
from goldpan.functions import similarity as S
from goldpan.functions import text as T


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column("v").alias("r")).first()["r"]


@pytest.mark.parametrize("f, value, want", [
    (T.clean_text, "  ﬁne  ", "fine"), (T.clean_text, "   ", None), (T.clean_text, None, None), (T.slugify, " Àéro & Co. ", "aero-co"), (T.slugify, "日本", None),
    (T.normalize_email, " Jane@Aero.Example ", "jane@aero.example"), (T.normalize_email, "jane@", None), (T.normalize_email, "@x", None), (T.normalize_email, "a@b@c", "a@b@c"),
    (T.normalize_website, "http://WWW.Aero.example/a/?q=1#x", "https://aero.example/a"), (T.normalize_website, "aero.example", "https://aero.example"), (T.normalize_website, None, None),
    (T.normalize_province, "KZN", "KwaZulu-Natal"), (T.normalize_province, "kwazulu-natal", "KwaZulu-Natal"), (T.normalize_province, "Gauteng Province", "Gauteng"), (T.normalize_province, "new-found land", "New-Found Land"),
    (T.normalize_address, " 1  Main St ", "1 Main Street"), (T.normalize_address, "1 Main St. North", "1 Main Street North"), (T.normalize_address, None, ""),
    (T.normalize_phone, "082 123 4567", "+27821234567"), (T.normalize_phone, "+27 (11) 123-4567", "+27111234567"), (T.normalize_phone, "12", None), (T.normalize_phone, "none", None),
    (T.normalize_identifier, " a-1/2 b ", "A12B"), (T.normalize_postal_code, "0081", "0081"), (T.normalize_postal_code, "12", None), (T.normalize_company, "Inca Trading (Pty) Ltd", "inca"), (T.normalize_company, None, ""),
    (T.province_of_address, "1 Road, western cape", "Western Cape"), (T.email_domain, "a@b.c", "b.c"), (T.website_of_email, "a@b.c", "https://b.c"),
])
def test_text(spark, f, value, want):
    assert one(spark, f, value) == want


def test_lists_and_names(spark):
    assert one(spark, T.split_emails, "A@b.c; a@b.c | x, d@e") == ["a@b.c", "d@e"]
    assert one(spark, T.split_multi, " a ;; b, ") == ["a", "b"]
    name = one(spark, T.parse_person_name, "Dr. Ann Marie van Wyk")
    assert (name.title, name.given, name.middle, name.family) == ("Dr.", "Ann", "Marie van", "Wyk")
    assert one(spark, T.parse_person_name, " ") is None


@pytest.mark.parametrize("value, want", [("2025-03-10", "2025-03-10"), ("March 10, 2025", "2025-03-10"), ("10/03/2025", "2025-03-10"), ("03/25/2025", "2025-03-25"), ("2025-01-02T03:04:05Z", "2025-01-02"), ("soon", None), (None, None)])
def test_dates(spark, value, want):
    assert one(spark, lambda c: F.date_format(D.flexible_timestamp(c), "yyyy-MM-dd"), value) == want


def test_scales(spark):
    got = spark.createDataFrame([(x,) for x in (-1.0, 0.0, 0.5, 1.0, 2.0)], "v double").select(T.logistic_scale("v").alias("r")).collect()
    assert [r.r for r in got] == [0.0, 0.0, 0.5, 1.0, 1.0]


def test_checks(spark):
    rows = spark.createDataFrame([("a@example.com", "082 123 4567"), ("a@shop.example", "12345678"), ("bad", "x"), (None, None)], "e string, p string")
    got = rows.select(C.validate_email("e").alias("e"), C.validate_phone("p").alias("p")).collect()
    assert [r.e and (r.e.status, r.e.confidence) for r in got] == [("deliverable", 0.92), ("risky", 0.35), ("undeliverable", 0.0), None]
    assert [r.p and r.p.status for r in got] == ["deliverable", "risky", "undeliverable", None]


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        prev = 0
        for j, y in enumerate(b):
            prev, row[j + 1] = row[j + 1], prev + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_indel_is_brute_force():
    r = random.Random(5)
    for _ in range(300):
        a, b = ("".join(r.choice("abc") for _ in range(r.randint(0, 12))) for _ in "xy")
        want = 2 * _lcs(a, b) / (len(a) + len(b)) if a or b else 1.0
        assert S.indel(a, b) == pytest.approx(want)
        assert S.indel(a, b) == S.indel(b, a)


def test_similarity_udfs(spark):
    S.register(spark)
    r = spark.sql("SELECT token_sort_ratio('b a', 'a b') AS x, partial_ratio('abc', 'xxabcxx') AS y, token_set_ratio('a b', 'a b c') AS z, token_sort_ratio(null, 'a') AS n").first()
    assert (r.x, r.y, r.z, r.n) == (1.0, 1.0, 1.0, 0.0)
    assert difflib.SequenceMatcher(None, "abc", "abd").ratio() == pytest.approx(2 / 3)
