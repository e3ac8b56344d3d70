"""Text predicates and scalar functions on columns. Nulls give null, or false for predicates."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word lists and patterns that results depend on.
HARD_WORDS = ("Vol", "Tom", "Contents", "Editorial", "Digest")
SOFT_WORDS = ("Table", "Fig", "Figure", "Note", "Ref", "Refs", "Abstract", "Introduction", "Review", "Source", "Section", "Appendix", "Methods", "Results", "Effects")
LABELS = ("Таблица", "Рисунок", "Рис", "Схема", "Приложение", "Пример", "Table", "Figure", "Fig", "Appendix")
GREETINGS = ("уважаемые", "с уважением", "дорогие", "коллеги", "читатели", "авторы и читатели")
SIGNATURES = ("доктор медицинских наук", "доктор биологических наук", "профессор кафедры", "заведующая лабораторией", "заведующий лабораторией", "приглашенный редактор")
ADDRESSED = ("коллег", "читател", "автор")
BLACKLIST = ("2025. том 24. номер 12", "оригинальное исследование", "краткое сообщение")
DOI = r"(?iu)\b10\.\d{4,9}/[-._;()/:A-Z0-9]+\b"
AFFILIATION = r"(?iu)университет|институт|больниц|центр|кафедр|факультет|академ"
ADDRESS = r"(?iuU)\bг\.\s|ул\.\s|пр\.\s|д\.\s|Россия|РФ|Москва|Санкт-Петербург"
ABSTRACT = r"(?iuU)^\s*Аннотация\b[:\s]*"
CONTENTS = r"(?iuU)\b(содержание|contents)\b"
RUNNING_HEADER = r"(?iuU)(?:^|;\s*)(?:Vol(?:ume)?\.?\s+\d|Том\s+\d)"
LETTER = "A-Za-zА-Яа-яЁё"
BYLINE = rf"(?U)^[{LETTER}]+[\s,]+[{LETTER}]\.\s*[{LETTER}]\."
SINGLE_BYLINE = rf"(?U)^[{LETTER}]+[\s,]+[{LETTER}]\.\s*$"
BYLINE_PREFIX = rf"(?U)^([{LETTER}]+[\s,]+[{LETTER}]\.)\s"
CYRILLIC = "Ѐ-ӿ"
#: Unicode white space, which is what \s matches with (?U).
WHITE = "\t\n\x0b\f\r \x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
#: Letters written as one letter, and those written as several or none.
ONE_TO_ONE = ("АБВГДЕЁЗИЙКЛМНОПРСТУФЫЭабвгдеёзийклмнопрстуфыэ", "ABVGDEEZIYKLMNOPRSTUFYEabvgdeeziyklmnoprstufye")
ONE_TO_MANY = (("Ж", "Zh"), ("Х", "Kh"), ("Ц", "Ts"), ("Ч", "Ch"), ("Ш", "Sh"), ("Щ", "Shch"), ("Ю", "Yu"), ("Я", "Ya"), ("Ъ", ""), ("Ь", ""), ("ж", "zh"), ("х", "kh"), ("ц", "ts"), ("ч", "ch"), ("ш", "sh"), ("щ", "shch"), ("ю", "yu"), ("я", "ya"), ("ъ", ""), ("ь", ""))
#: Letters whose full capital is several letters, and the one letter that is theirs (ß, Greek with iota below); others of that sort have none.
_IOTA = [chr(i) for i in range(0x1F80, 0x1FB0) if not i & 8]
ONE_CAPITAL = ("ß" + "".join(_IOTA) + "ᾳῃῳ", "ẞ" + "".join(chr(ord(c) + 8) for c in _IOTA) + "ᾼῌῼ")


def _false(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def any_of(text: Column, parts: tuple[str, ...]) -> Column:
    return _false(reduce(or_, (text.contains(p) for p in parts)))


def stripped(text: Column) -> Column:
    """Without Unicode white space at either end."""
    return F.btrim(text, F.lit(WHITE))


def normal_space(text: Column) -> Column:
    """runs of white space as one space, none at the ends. Only runs that are no single space are matched."""
    return F.trim(F.regexp_replace(text, r"(?U)[\s&&[^ ]]\s*| \s+", " "))


def language(text: Column) -> Column:
    """ru if there is a Cyrillic letter, else en if there is a Latin one, else unknown."""
    return F.when(text.rlike("[А-ЯЁа-яё]"), "ru").when(text.rlike("[A-Za-z]"), "en").otherwise("unknown")


def is_contents_marker(text: Column) -> Column:
    """a short text with the heading as a whole word."""
    return _false((F.length(stripped(text)) <= 30) & text.rlike(CONTENTS))


def is_blacklisted(text: Column) -> Column:
    """F5."""
    return any_of(F.lower(text), BLACKLIST)


def _counts(text: Column) -> tuple[Column, Column]:
    cyrillic = F.length(F.regexp_replace(text, f"[^{CYRILLIC}]+", ""))
    latin = F.length(F.regexp_replace(text, "[^A-Za-z]+", ""))
    return cyrillic, latin


def is_cyrillic_dominant(text: Column) -> Column:
    """at least half of the letters; no letters: false; a tie satisfies both."""
    c, n = _counts(text)
    return _false((c + n > 0) & (2 * c >= c + n))


def is_latin_dominant(text: Column) -> Column:
    c, n = _counts(text)
    return _false((c + n > 0) & (2 * n >= c + n))


def is_greeting(text: Column) -> Column:
    """an address to readers or an editor's signature."""
    low = F.lower(text)
    return any_of(low, GREETINGS + SIGNATURES) | _false(F.length(text) > 200) | (_false(stripped(text).endswith("!")) & any_of(low, ADDRESSED))


def is_running_header(text: Column) -> Column:
    """F8."""
    return _false(stripped(text).rlike(RUNNING_HEADER))


def is_byline(text: Column) -> Column:
    """surname and two initials at the start."""
    return _false(stripped(text).rlike(BYLINE))


def first_word(text: Column) -> Column:
    """The first word without closing punctuation."""
    return F.regexp_replace(F.regexp_extract(stripped(text), r"(?U)^(\S+)", 1), "[.,;:]+$", "")


def capitalised(word: Column) -> Column:
    """The first character upper, one for one, the rest as it is. What has no single capital stays."""
    first = F.substring(word, 1, 1)
    upper = F.upper(first)
    return F.concat(F.when(F.length(upper) == 1, upper).otherwise(F.translate(first, *ONE_CAPITAL)), word.substr(F.lit(2), F.length(word)))


def is_single_byline(text: Column) -> Column:
    """surname and one initial, nothing else, no label or section word."""
    word = first_word(text)
    return _false(stripped(text).rlike(SINGLE_BYLINE) & ~word.isin(*LABELS) & ~capitalised(word).isin(*HARD_WORDS, *SOFT_WORDS))


def byline_prefix(text: Column) -> Column:
    """the single-initial byline that a longer text starts with, or null."""
    prefix = F.regexp_extract(stripped(text), BYLINE_PREFIX, 1)
    return F.when((prefix != "") & is_single_byline(prefix), prefix)


def _shape(name: Column) -> Column:
    short_caps = (name == F.upper(name)) & (name != F.lower(name)) & (F.length(name) <= 8)
    return (F.length(name) >= 2) & ~name.rlike(r"(?U)\d") & ~name.rlike(r"(?i)^rs\d+") & ~short_caps & ~name.rlike("[()]")


def is_surname(name: Column, last_step: bool = False) -> Column:
    """last_step adds the soft stop words."""
    word = capitalised(name)
    stop = HARD_WORDS + (SOFT_WORDS if last_step else ())
    return _false(_shape(name) & ~word.isin(*stop) & word.rlike("^[A-Z][a-z]"))


def is_english_surname(name: Column) -> Column:
    """no stop words, no capitalising."""
    return _false(_shape(name) & name.rlike("^[A-Z][a-z]"))


def abstract_text(text: Column) -> Column:
    """what follows the abstract marker, or null."""
    rest = stripped(F.regexp_replace(text, ABSTRACT, ""))
    return F.when(text.rlike(ABSTRACT) & (rest != ""), rest)


def transliterate(text: Column) -> Column:
    """Word-final -ый first, as it looks at what follows; then -ие-, -ню-, then letters. Texts without Cyrillic are left alone."""
    out = F.regexp_replace(text, f"(?<=[ыЫ])й(?![{CYRILLIC}])", "i")
    out = F.regexp_replace(out, f"(?<=[ыЫ])Й(?![{CYRILLIC}])", "I")
    out = F.regexp_replace(F.regexp_replace(out, "и[еЕ]", "iye"), "И[еЕ]", "Iye")
    out = F.regexp_replace(F.regexp_replace(out, "н[юЮ]", "niu"), "Н[юЮ]", "Niu")
    for a, b in ONE_TO_MANY:
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.when(text.rlike("[А-яЁё]"), F.translate(out, *ONE_TO_ONE)).otherwise(text)


def first_surname(authors: Column) -> Column:
    """Before the first comma, the first word, without closing punctuation; null if empty."""
    word = first_word(F.element_at(F.split(authors, ","), 1))
    return F.when(word != "", word)


def file_safe(name: Column) -> Column:
    """C4."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(name, "[^A-Za-z0-9_-]", "_"), "_+", "_"), "^_+|_+$", "")


def issue_prefix(issue_id: Column) -> Column:
    """mg_2025_12 -> Mg_2025-12."""
    p = F.split(issue_id, "_")
    return F.concat(F.initcap(F.get(p, 0)), F.lit("_"), F.get(p, 1), F.lit("-"), F.get(p, 2))


def journal_code(issue_id: Column) -> Column:
    """The part before the first underscore if it has two characters, else null."""
    part = F.substring_index(issue_id, "_", 1)
    return F.when(F.length(part) == 2, part)


def year_of(prefix: Column) -> Column:
    """C7."""
    y = F.regexp_extract(prefix, r"_(\d{4})-", 1)
    return F.when(y != "", y)


def padded_page(page: Column) -> Column:
    """Three digits at least."""
    return F.format_string("%03d", page.cast("long"))


def is_issue_id(issue_id: Column, code: Column) -> Column:
    """code_YYYY_MM with the journal's code and a month from 1 to 12."""
    p = F.split(stripped(issue_id), "_")
    digits = F.get(p, 1).rlike("^[0-9]{4}$") & F.get(p, 2).rlike("^[0-9]+$")
    return _false((F.size(p) == 3) & (F.lower(F.get(p, 0)) == F.lower(stripped(code))) & digits & F.when(digits, F.get(p, 2).cast("decimal(38,0)").between(1, 12)))


def name_prefix(code: Column, issue_id: Column) -> Column:
    """C10."""
    p = F.split(issue_id, "_")
    return F.concat(stripped(code), F.lit("_"), F.get(p, 1), F.lit("-"), F.get(p, 2))


def plural_articles(n: Column) -> Column:
    """C11: the Russian plural."""
    m = F.abs(n) % 100
    return F.when(m.between(11, 19), "статей").when(m % 10 == 1, "статья").when((m % 10).between(2, 4), "статьи").otherwise("статей")


def timestamp_id(clock: Column) -> Column:
    """The clock is handed in, so results can be repeated."""
    return F.date_format(clock, "yyyy_MM_dd__HH_mm_ss")


def base_name(path: Column) -> Column:
    """C13."""
    return F.element_at(F.split(path, "/"), -1)


def json_field(doc: Column, name: str) -> Column:
    """C14: the field in `data`, else at the top."""
    return F.coalesce(F.get_json_object(doc, f"$.data.{name}"), F.get_json_object(doc, f"$.{name}"))


def file_name(prefix: Column, kind: Column, lo: Column, hi: Column, surname: Column) -> Column:
    """the suffix is the surname for research, else the kind's name."""
    suffix = F.when(kind == "research", file_safe(surname)).otherwise(F.initcap(kind))
    return F.concat(prefix, F.lit("_"), padded_page(lo), F.lit("-"), padded_page(hi), F.lit("_"), suffix, F.lit(".pdf"))
