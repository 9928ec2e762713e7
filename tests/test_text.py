import random
import unicodedata

from pyspark.sql import functions as F

from placeweave.functions import text as T


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")


def ask(spark, values, *columns):
    out = texts(spark, values).select("i", *columns).orderBy("i").collect()
    return [tuple(r)[1:] if len(columns) > 1 else r[1] for r in out]


def test_normalize_matches_unicode_tables(spark):
    rnd = random.Random(7)
    alphabet = [chr(c) for lo, hi in ((0x20, 0x7F), (0x4E00, 0x4E40), (0xFF01, 0xFF5E), (0xA0, 0x180), (0x300, 0x310), (0xF900, 0xF920), (0x2070, 0x20A0), (0xAC00, 0xAC10), (0x1100, 0x1110), (0x2000, 0x200B)) for c in range(lo, hi)]
    alphabet += ["\t", "\n", "\x1c", "\x1f", "\x85", "　", "ﬁ", "é", "①", "㎏", "ア", "ｱ", "ﾞ"]
    values = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 12))) for _ in range(4000)] + [None, "", " 晴川邨 ", "\x1dA"]
    got = [r.t for r in T.normalize_text_columns(texts(spark, values), ["t"]).orderBy("i").collect()]
    assert got == [unicodedata.normalize("NFKC", v.strip()) if v else v for v in values]


def test_screened_characters_never_change():
    safe = [*range(0x80), *range(0x3400, 0x4DC0), *range(0x4E00, 0xA000)]
    assert all(unicodedata.normalize("NFKC", chr(c)) == chr(c) and unicodedata.combining(chr(c)) == 0 for c in safe)


def test_slugify(spark):
    values = ["Tai Po", "  大埔 墟! ", "A_b--c  d", "Hong　Kong", "é!x", "①a\x1cb", None]

    expected = ["tai-po", "大埔-墟", "a_b--c-d", "hong-kong", "éx", "①a-b", None]
    assert ask(spark, values, T.slugify(F.col("t"))) == expected


def test_split_combined_name(spark):
    values = ["旺角 Mong Kok", "古洞 Kwu Tung", "Mong Kok", None, "  大角咀　Tai Kok Tsui ", "旺角Mong Kok", "旺角 Mong Kok 2!"]
    expected = [("旺角", "Mong Kok"), ("古洞", "Kwu Tung"), (None, None), (None, None), ("大角咀", "Tai Kok Tsui"), (None, None), (None, None)]
    assert ask(spark, values, *T.split_combined_name(F.col("t"))) == expected


def test_map_district(spark):
    values = ["沙田區", "SHA TIN DISTRICT", "Sha Tin", "YUEN LONG DISTRICT", "Tai Po Dist.", "Tai-Po District", "central and western",
              "Central & Western District", "沙田區 District", "Atlantis", "", None, " 東區 "]
    expected = ["Sha Tin", "Sha Tin", "Sha Tin", "Yuen Long", "Tai Po", "Tai Po", "Central & Western", "Central & Western", "Sha Tin",
                None, None, None, "Eastern"]
    assert ask(spark, values, T.map_district(F.col("t"))) == expected


def test_inject_is_idempotent(spark):
    df = spark.createDataFrame(
        [("新界元朗區試驗徑8號", "元朗區", "水邊", "8 Trial Path, Yuen Long District, New Territories", "Yuen Long District", "Water Side")],
        "ac string, dc string, sc string, ae string, de string, se string",
    )

    def splice(d):
        return d.withColumns(
            {
                "ac": T.inject_sub_district(F.col("ac"), F.col("dc"), F.col("sc"), before_district=False),
                "ae": T.inject_sub_district(F.col("ae"), F.col("de"), F.col("se"), before_district=True),
            }
        )

    once, twice = splice(df).first(), splice(splice(df)).first()
    assert once.ac == "新界元朗區 水邊試驗徑8號" and once.ae == "8 Trial Path, Water Side Yuen Long District, New Territories"
    assert once == twice


def test_place_phrase(spark):
    values = ["Flat 3, Happy Valley Court, Kowloon", "no such thing", "Estate", "x Estate y Tower z", None, "a,Lee Garden", "Garden. B Plaza"]

    expected = ["Happy Valley Court", None, None, "x Estate y Tower", None, "Lee Garden", "B Plaza"]
    assert ask(spark, values, T.extract_place_phrase(F.col("t"))) == expected
    long = "lorem ipsum " * 20000
    assert ask(spark, [long, long + "Tower", long + ". Old Tower"], F.length(T.extract_place_phrase(F.col("t")))) == [None, len(long) + 5, 9]
