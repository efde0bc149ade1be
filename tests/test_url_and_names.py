from pyspark.sql import functions as F

from folioforge.functions import names
from folioforge.functions import url as U


def apply(spark, f, values):
    df = spark.createDataFrame([(n, v) for n, v in enumerate(values)], "n int, v string")
    return [r.o for r in df.select("n", f(F.col("v")).alias("o")).orderBy("n").collect()]


def test_host_and_slug(spark):
    urls = [
        "https://blog-en.example/a-b/",
        " HTTPS://www.Blog-EN.example:443/a%2DB?ref=x ",
        "https://u:p@blog-en.example//x//y//#top",
        "//blog-en.example/y",
        "blog-en.example/y",
        "https://blog-en.example/%ED%95%98%EB%85%B8/",
        "https://blog-en.example",
        "https://blog-en.example/100%/",
        "",
        None,
    ]
    assert apply(spark, U.host_of, urls) == ["blog-en.example"] * 8 + ["", None]
    assert apply(spark, U.slug_of, urls) == ["a-b", "a-b", "y", "y", "y", "하노", "", "100%", "", None]


def test_clean_url(spark):
    cases = {
        "https://h/a/size/w600/b.png": "https://h/a/b.png",
        "https://h/a/SIZE/w256h256/b.png//": "https://h/a/b.png",
        "https://h/a.png?ref=x": "https://h/a.png",
        "https://h/a?a=1&ref=x&b=2": "https://h/a?a=1&b=2",
        "https://h/a?ref=1&ref=2#top": "https://h/a#top",
        "https://h/a?href=1": "https://h/a?href=1",
        "https://cdn.h/image/lk/ko/p/x.png": "https://cdn.h/image/lk/ko/o/x.png",
        "https://h/p/x/": "https://h/p/x",
        None: None,
        "": "",
    }
    assert apply(spark, U.clean_url, cases) == list(cases.values())
    once = apply(spark, U.clean_url, cases)
    assert apply(spark, U.clean_url, once) == once


def test_image_key(spark):
    one = ["https://CDN.h/image/lk/ko/p/x.png/?ref=home", "http://cdn.h/image/lk/ko/o/size/W100/x.png", "//cdn.h/image/lk/ko/o/x.png", "cdn.h/image/lk/ko/o/x.png"]
    df = spark.createDataFrame([(n, v, "x") for n, v in enumerate([*one[:1], *one[2:3], None, "", "https://h/A.png", "https://H/a.png"])], "n int, u string, `__t` string")
    got = [r.k for r in U.with_image_key(df, F.col("u"), "k").orderBy("n").collect()]
    assert got[0] == got[1] and got[2] is None and got[3] == "" and got[4] == "h/A.png" and got[5] == "h/a.png"


def test_link_keys_and_variants(spark):
    assert apply(spark, U.link_key, ["http://H:80/a%20b/size/w1/c/?q", "https://h/", "https://h"]) == ["h/a b/c", "h/", "h"]
    assert apply(spark, lambda u: U.language_variant(u, F.lit("en.h"), F.lit("_EN")), ["https://ko.h/x_KO.png", "https://ko.h/x_ko_2_KO-3", "https://ko.h/x_KOR"]) == ["https://en.h/x_EN.png", "https://en.h/x_EN_2_EN-3", "https://en.h/x_KOR"]
    assert apply(spark, U.original_of_snapshot, ["https://web.archive.org/web/20200101000000im_/https://h/a", "https://h/a"]) == ["https://h/a", "https://h/a"]
    assert apply(spark, U.snapshot_image_url, ["https://web.archive.org/web/20200101000000/https://h/a"]) == ["https://web.archive.org/web/20200101000000im_/https://h/a"]
    assert apply(spark, lambda u: U.moved(u, "cdn.h", "forum.h", "/s"), ["https://cdn.h/a/b", "https://h/a"]) == ["https://forum.h/s/a/b", None]


def test_names(spark):
    assert apply(spark, names.basename, ["https://h/a/b%20c.PNG?x", "https://h/a/", "https://h"]) == ["b c.PNG", "a", ""]
    assert apply(spark, names.suffix, ["b c.PNG", ".htaccess", "a.tar.gz", "x"]) == [".png", "", ".gz", ""]
    assert apply(spark, names.safe_filename, ['a/b:c*?"<>|', "", "x" * 300]) == ["a_b_c______", "image", "x" * 200]
    assert apply(spark, names.extension_of_mime, ["image/JPEG; q=1", "x/y", None]) == [".jpg", ".bin", ".bin"]
    latin = "한글.png".encode().decode("latin-1")
    assert apply(spark, names.disposition_filename, ["attachment; filename*=UTF-8''%ED%95%9C.png", f'attachment; filename="{latin}"', "inline; filename=a.zip; x=1", "inline", None])[:4] == ["한.png", "한글.png", "a.zip", ""]
    assert apply(spark, names.url_slug, ["https://h/a/b/", "https://h"]) == ["b", "https___h"]
    assert apply(spark, names.title_slug, [" A  b_c-- d "]) == ["A-b-c-d"]
    assert apply(spark, names.date_folder, ["2024-05-06", "2024", "", None]) == ["2024/05", "2024", "unknown", "unknown"]
    assert apply(spark, lambda c: names.long_date_ko(c.cast("date")), ["2024-01-07"]) == ["2024년 1월 7일 일요일"]
    assert apply(spark, lambda c: names.source_tag(c, {"pf.channel": "[Channel]", "blog-en": "[EN]"}), ["http://pf.channel.example/1", "https://blog-en.h/", "x"]) == ["[Channel]", "[EN]", ""]


def test_joining_and_encoding(spark):
    assert apply(spark, lambda c: names.url_join(F.lit("https://h/a/b"), c), ["../c", "//x/y", "?q", "http://[", None]) == ["https://h/c", "https://x/y", "https://h/a/b?q", "http://[", None]
    assert apply(spark, names.strip_ref_encoded, ["https://h/?a=1 2&ref=x&b=&a=3", "https://h/?a=1 2", None]) == ["https://h/?a=1+2&a=3&b=", "https://h/?a=1 2", None]
