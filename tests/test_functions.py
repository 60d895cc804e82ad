"""Column functions against the standard library and hand tables."""

import random
import string
from pathlib import PurePosixPath
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from crawlsight.functions import keys, naming, text


def evaluate(spark, rows, schema, *columns):
    frame = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], f"i int, {schema}")
    found = frame.select("i", *[c.alias(f"c{j}") for j, c in enumerate(columns)]).orderBy("i").collect()
    return [tuple(row)[1:] if len(columns) > 1 else row[1] for row in found]


EXTENSIONS = [
    ("http://a/x.PDF?q=1", None, ".pdf"),
    ("http://a/.pdf", None, ""),
    ("http://a/...x", None, ".x"),
    ("http://a/x.tar.gz", None, ".gz"),
    ("http://a/x.", None, ""),
    ("http://a/d.e/x", None, ""),
    ("http://a/x.pdf;v=1", None, ".pdf"),
    ("s3://b/x.pdf;v=1", None, ".pdf;v=1"),
    ("http://a/sp ace.pdf", None, ".pdf"),
    ("http://a/x.pdf/", None, ".pdf"),
    ("http://a/x.aspx", "pdf", ".aspx"),
    ("http://a/x", "PDF", ".pdf"),
    ("http://a/x", "audio", ".mp3"),
    ("http://a/x", "weird", ""),
    ("http://a/x", None, ""),
]


def test_extension_hand_table(spark):
    found = evaluate(
        spark,
        [(url, kind) for url, kind, _ in EXTENSIONS],
        "url string, kind string",
        keys.file_extension(F.col("url"), F.col("kind")),
    )
    assert found == [ext for _, _, ext in EXTENSIONS]


def test_extension_random_urls(spark):
    rng = random.Random(7)
    alphabet = string.ascii_letters + string.digits + "./.;:?#&=-_ %~\t"
    urls = []
    for _ in range(3000):
        head = rng.choice(["http://h", "https://h.org", "ftp://h", "s3://b", "mailto:", "", "//h", "/"])
        tail = "".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 18)))
        urls.append(head + "/" * rng.randrange(0, 3) + tail)

    def expected(url):
        return PurePosixPath(urlparse(url).path).suffix.lower()

    kept, wanted = [], []
    for url in urls:
        try:
            wanted.append(expected(url))
            kept.append((url, None))
        except ValueError:
            continue
    found = evaluate(
        spark, kept, "url string, kind string", keys.file_extension(F.col("url"), F.col("kind"))
    )
    wrong = [(u[0], a, b) for u, a, b in zip(kept, found, wanted) if a != b]
    assert wrong == []


def test_content_and_pointer_keys(spark):
    import hashlib

    body = "Größe\n"
    sha = hashlib.sha256(body.encode()).hexdigest()
    found = evaluate(
        spark,
        [(body,)],
        "b string",
        keys.content_key(F.lit("p/"), keys.content_sha(F.col("b")), F.lit(".x")),
        keys.dedup_pointer_key(F.lit("p/"), F.col("b")),
        keys.has_key(F.col("b")),
    )
    assert found == [(f"p/{sha[:2]}/{sha[2:4]}/{sha}.x", f"p/_dedup/{sha}", True)]
    assert evaluate(spark, [("",), (None,)], "b string", keys.has_key(F.col("b"))) == [False, False]


SLUGS = [
    ("m.p:ArkansasAppellateScraper", "arkansas_appellate"),
    ("a:Outer.InnerScraper", "inner"),
    ("a:NYCourtsScraper", "ny_courts"),
    ("a:HTTPServer2ABCd", "http_server2_ab_cd"),
    ("a:X_Y2Z", "x_y2_z"),
    ("a:_Foo__BarScraper", "foo_bar"),
    ("a:ScraperScraper", "scraper"),
    ("a:Scraper", ""),
    ("NoColon", "no_colon"),
    ("a:b:CScraper", "c"),
]


def test_slug_hand_table(spark):
    found = evaluate(spark, [(p,) for p, _ in SLUGS], "p string", naming.source_slug(F.col("p")))
    assert found == [slug for _, slug in SLUGS]


def slug_by_letters(name):
    """The word borders, found letter by letter."""
    stem = name[: -len("Scraper")] if name.endswith("Scraper") else name
    out = ""
    for i, c in enumerate(stem):
        before, after = stem[i - 1 : i], stem[i + 1 : i + 2]
        small_before = before and (before in string.ascii_lowercase or before in string.digits)
        if c in string.ascii_uppercase and before:
            acronym_ends = before in string.ascii_uppercase and after and after in string.ascii_lowercase
            if small_before or acronym_ends:
                out += "_"
        out += c
    return "_".join(part for part in out.split("_") if part).lower()


def test_slug_random_names(spark):
    rng = random.Random(11)
    names = ["".join(rng.choice("aAbBzZ09__") for _ in range(rng.randrange(0, 12))) for _ in range(2000)]
    names += [name + "Scraper" for name in names[:300]]
    found = evaluate(spark, [("m:" + n,) for n in names], "p string", naming.source_slug(F.col("p")))
    assert found == [slug_by_letters(n) for n in names]


@pytest.mark.parametrize(
    "module,is_test",
    [("p.tests.x", True), ("p.test_a", True), ("p.conftest", True), ("p.contest.x", False), ("p.attest", False)],
)
def test_test_modules(spark, module, is_test):
    assert evaluate(spark, [(module,)], "m string", naming.is_test_module(F.col("m"))) == [is_test]


def test_path_validity(spark):
    paths = [("m:C",), ("m:",), ("m",), ("",), (None,), (":C",)]
    found = evaluate(spark, paths, "p string", naming.path_is_valid(F.col("p")))
    assert found == [True, False, False, False, False, True]


def test_browser_and_courts(spark):
    rows = [(["JS_EVAL", "X"], ["b", "a"]), (["X"], []), (None, None), (["HCaptchaHandler"], ["z"])]
    found = evaluate(
        spark,
        rows,
        "r array<string>, c array<string>",
        naming.needs_browser(F.col("r")),
        naming.court_tags(F.col("c")),
    )
    assert found == [(True, ["court:a", "court:b"]), (False, []), (False, []), (True, ["court:z"])]


def test_error_text(spark):
    found = evaluate(
        spark, [("a|b\nc",), (None,), ("",)], "m string", text.error_text_clean(F.col("m"))
    )
    assert found == ["a\\|b c", "", ""]
