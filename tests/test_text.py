"""Literal cases of the text rules."""

import pytest
from pyspark.sql import functions as F

from foliary.functions import text as T

CASES = [
    (T.is_running_header, ["Vol. 7, No. 12", "VOL 3", "Volume 40", "2024; Vol 9", "Том 5", "сборник; том 11, № 2", "  vol. 1"], ["Кузнецов В.А.", "Volga 3", "", "Vol. three", "1; 2", None]),
    (T.is_byline, ["Lebedev A.N.", "Новикова е.р.", "Сорокин  П. К., Белова А.А.", "Ёлкина, Ю.Я. и другие"], ["Схема В.", "Рис. 2.", "Том 5", "итоги: год", "А.Б. Сорокин", None]),
    (T.is_single_byline, ["Морозов Т.", "Baker W. "], ["Сорокин П.К.", "Рисунок Б.", "Review C.", "Т.", "Vol V."]),
    (T.is_surname, ["Lebedev", "Schema", "novikova"], ["Tom", "digest", "B", "CD", "Xy2", "rs7", "De(f", "ABCDEFGH", None]),
    (lambda c: T.is_surname(c, True), ["Lebedev"], ["Figure", "Review"]),
    (T.is_english_surname, ["Sorokina"], ["HLA2", "sorokina", "XYZ"]),
    (T.is_contents_marker, ["СОДЕРЖАНИЕ", "Contents", "table of contents", " содержание:"], ["Сontents", "malcontents", "contents of " + "y" * 30, None]),
    (T.is_cyrillic_dominant, ["эюя", "эю xy"], ["xyz", "7-8", ""]),
    (T.is_latin_dominant, ["xyz", "эю xy"], ["эюя", "7-8", ""]),
    (T.is_greeting, ["Дорогие друзья", "y" * 201, "Вас ждёт читатель!", "профессор кафедры"], ["Петрова А.А.", "Ура!", "y" * 200, None]),
]

# Fixed values, told again.
WORD_LISTS = {
    "HARD_WORDS": "Vol Tom Contents Editorial Digest", "SOFT_WORDS": "Table Fig Figure Note Ref Refs Abstract Introduction Review Source Section Appendix Methods Results Effects",
    "LABELS": "Таблица Рисунок Рис Схема Приложение Пример Table Figure Fig Appendix", "ADDRESSED": "коллег читател автор",
}


def test_word_lists():
    for name, words in WORD_LISTS.items():
        assert list(getattr(T, name)) == words.split()
    assert len(T.GREETINGS) == len(T.SIGNATURES) == 6
    assert T.BLACKLIST == ("2025. том 24. номер 12", "оригинальное исследование", "краткое сообщение")


@pytest.mark.parametrize("rule,yes,no", CASES)
def test_predicates(spark, rule, yes, no):
    df = spark.createDataFrame([(x, True) for x in yes] + [(x, False) for x in no], "t string, want boolean")
    wrong = df.withColumn("got", rule(F.col("t"))).where("got <> want or got is null").collect()
    assert wrong == []


def values(spark, f, cases):
    df = spark.createDataFrame(list(cases.items()), "t string, want string")
    return df.withColumn("got", f(F.col("t"))).where("not (got <=> want)").collect()


def test_functions(spark):
    names = {"Красный": "Krasnyi", "Майский": "Mayskiy", "Лавровой": "Lavrovoy", "Выйду": "Vyydu", "Алиева": "Aliyeva", "Нюша": "Niusha", "Щёкин": "Shchekin", "Подъяпольский": "Podyapolskiy"}
    assert values(spark, T.transliterate, names) == []
    assert values(spark, T.byline_prefix, {"Морозов Т. Зима в": "Морозов Т.", "Морозов Т.": None, "Рисунок А. x": None}) == []
    assert values(spark, T.first_surname, {"Белова Ю.С., Орлов О.П.": "Белова", "Baker.": "Baker", "": None, ", x": None}) == []
    assert values(spark, T.normal_space, {" a  b \n c ": "a b c"}) == []
    assert values(spark, T.capitalised, {"deVries i": "DeVries i"}) == []
    assert values(spark, T.issue_prefix, {"mg_2025_12": "Mg_2025-12"}) == []
    assert values(spark, T.abstract_text, {"Аннотация: цель": "цель", "Аннотация ": None, "Цель": None}) == []
    assert values(spark, lambda c: T.padded_page(c.cast("int")), {"7": "007", "1000": "1000"}) == []


def test_capital_is_one_letter_as_in_sql(spark):
    """A line that begins with ß had SS for it, where the SQL has one letter."""
    import duckdb

    from foliary.plans.catalog import _cap

    words = [f"{a}bc" for a in ["ß", "ŉ", "ΐ", "ﬁ", *T.ONE_CAPITAL[0], *T.ONE_CAPITAL[1], "é", "я", "z", "Z", "1"]] + ["", "ß"]
    got = spark.createDataFrame([(w,) for w in words], "t string").select("t", T.capitalised(F.col("t"))).collect()
    want = duckdb.execute(f"select t, {_cap('t')} from (select unnest(?::varchar[]) as t)", [words]).fetchall()
    assert sorted(map(tuple, got)) == sorted(want)
    assert values(spark, T.capitalised, {"ßen": "ẞen", "ﬁn": "ﬁn"}) == []


def test_white_space_is_unicodes(spark):
    """The rules that are fast on plain spaces do as the patterns they stand for."""
    from itertools import product

    texts = ["".join(x) for n in range(4) for x in product("a \n  \x85\x1f", repeat=n)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    c = F.col("t")
    assert df.where(T.stripped(c) != F.regexp_replace(c, r"(?U)^\s+|\s+$", "")).count() == 0
    assert df.where(T.normal_space(c) != F.trim(F.regexp_replace(c, r"(?U)\s+", " "))).count() == 0
