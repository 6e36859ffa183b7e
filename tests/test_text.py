import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from profilematch import Dictionaries, normalize_text
from profilematch.functions import text as T
from profilematch.operators.lookup import replace_emoji
from profilematch.sources.dictionaries import term_map, word_list

GOLDEN = [
    (None, "", False, ""),
    ("", "", False, ""),
    ("   ", "", False, ""),
    ("Hello, TEAM!", "hello team", True, "xin chào nhóm"),
    ("Cty ko OT, lv vs team Nhật", "cty ko ot lv vs team nhật", True, "công ty không ot làm việc nhóm nhật"),
    ("zzz 5 g gà ml", "zzz 5 gà", True, "5 gà"),
    ("5g sữa", "5g sữa", True, "5g sữa"),
    ("a_lô alô", "alô alô", True, "alô alô"),
    ("• Java – Spring", " java – spring", True, "java – spring"),
    ("C++ / C# / .NET", "c c net", True, "c c net"),
    ("a\\b", "a\\b", True, "a\\b"),
    ("G-ML", "gml", True, "gml"),
    ("ở ế ỗ hello", "ở ế ỗ hello", True, "ở ế ỗ xin chào"),
    ("và và là", "và và là", False, ""),
]
MARKS = "!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~"


@pytest.fixture(scope="module")
def dictionaries(spark):
    return Dictionaries(
        term_map(spark, {"hello": "xin chào", "team": "nhóm"}),
        term_map(spark, {"ko": "không", "vs": "với", "cty": "công ty", "lv": "làm việc"}),
        word_list(spark, ["zzz"]),
        word_list(spark, ["với", "và", "là", "a_lô", "cty"]),
    )


@pytest.mark.parametrize("max_terms", [1000, 2])
def test_golden_in_row_and_by_join(spark, dictionaries, max_terms):
    df = spark.createDataFrame([(i, g[0]) for i, g in enumerate(GOLDEN)], "id long, t string")
    out = normalize_text(df, "id", "t", dictionaries, max_constant_terms=max_terms)
    out = out.withColumns({"c": T.clean_text("t"), "e": T.is_english(T.clean_text("t"))})
    rows = [(r.t, r.c, r.e, r.normalized) for r in out.orderBy("id").collect()]
    assert rows == GOLDEN


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab gml\t _-\\[]^!éà•·　", max_size=30), min_size=20, max_size=40))
def test_cleaning_properties(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, t string")
    for r in df.select("t", T.clean_text("t").alias("c"), T.tokens_ws(T.clean_text("t")).alias("w")).collect():
        assert not set(r.c) & set(MARKS)
        assert r.w == r.c.split()
        assert not {"g", "ml"} & set(r.w)
        assert "  " not in r.c


def test_tokens_and_blank(spark):
    df = spark.createDataFrame([("Một từ, a b1 x_y",), (" \t ",), (None,)], "t string")
    rows = df.select(T.tokens_word("t").alias("w"), T.is_blank("t").alias("b")).collect()
    assert [r.w for r in rows] == [["một", "từ", "b1", "x_y"], [], []]
    assert [r.b for r in rows] == [False, True, True]


def test_emoji(spark):
    df = spark.createDataFrame([("good👍❤️ $1 day",), ("none",)], "t string")
    emoji = term_map(spark, {"👍": "thích", "❤": "yêu", "❤️": "yêu lắm"})
    rows = [r[0] for r in df.select(replace_emoji(df.t, emoji)).collect()]
    assert rows == ["good thích  yêu lắm  $1 day", "none"]


def test_normalisation_needs_no_shuffle_and_no_python(spark, dictionaries, capsys):
    df = spark.range(5).selectExpr("id", "'a b' AS t")
    normalize_text(df, "id", "t", dictionaries).explain()
    plan = capsys.readouterr().out
    assert "Exchange" not in plan and "Python" not in plan and "Join" not in plan
