"""Units of mass per time in free text, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fluvion.functions.text import fold_accents

# Kilograms of each unit of mass, by the words and signs that name it.
MASS_KG = {
    1e-6: "mg milligram milligrams milligramme milligrammes milligramm milligramos",
    1e-3: "g gram grams gramme grammes gramm gramos gramas",
    1.0: "kg kgs kilo kilos kilogram kilograms kilogramme kilogrammes kilogramm kilogramos quilogramas 千克 公斤 кг",
    0.45359237: "lb lbs pound pounds libra libras",
    907.18474: "short-ton short-tons us-short-ton us-short-tons us-ton us-tons",
    1016.0469088: "long-ton long-tons imperial-ton imperial-tons",
    1e3: "t ton tons tonne tonnes tonnen tonelada toneladas metric-ton metric-tons metric-tonne metric-tonnes tonne-metrique tonnes-metriques megagram megagrams 吨 т тонн",
    1e6: "kt ktons kiloton kilotons kilotonne kilotonnes kilotonnen kilotoneladas gg gigagram gigagrams 千吨 тыс-т",
    1e9: "mt megaton megatons megatonne megatonnes megatonnen megatoneladas tg teragram teragrams 百万吨",
}

# Days of each unit of time; 0 stands for the calendar month of the reading.
TIME_DAYS = {
    1 / 86400: "s sec secs second seconds seconde secondes segundo segundos sekunde sekunden 秒 с сек",
    1 / 1440: "min mins minute minutes minuto minutos minuten 分钟 мин",
    1 / 24: "h hr hrs hour hours heure heures hora horas stunde stunden hourly 小时 ч час",
    1.0: "d day days dia dias jour jours tag tage daily quotidien taglich 天 日 сут сутки день",
    7.0: "wk week weeks semaine semana woche weekly 周",
    0.0: "mo mon month months mois mes meses monat monate monthly mensuel mensual monatlich 月 мес месяц",
    365.25: "a an y yr yrs year years ans annee annees ano anos jahr jahre annum annually annual yearly annuel anual jahrlich 年 год",
}

# Words and signs in front of a unit that multiply it.
MULTIPLIERS = {1e3: r"10\s?\^\s?3 10\*\*3 1e3 1000 thousand thousands mil mille milliers tausend miles", 1e6: r"10\s?\^\s?6 10\*\*6 1e6 1000000 million millions millionen millon millones milhao milhoes"}

_SIGNS = {"⁰": "^0", "¹": "^1", "²": "^2", "³": "^3", "⁶": "^6", "⁻": "^-"}


def _alternatives(table: dict) -> str:
    words = [w.replace("-", r"[\s-]+") for v in table.values() for w in v.split()]
    return "|".join(sorted(words, key=len, reverse=True))


_UNIT = (
    rf"(?:(?<![\p{{L}}\p{{N}}.,^])(?:x\s*)?({'|'.join(v.replace(' ', '|') for v in MULTIPLIERS.values())})\s*(?:of\s+|de\s+|x\s*)?)?"
    rf"(?<![\p{{L}}^])({_alternatives(MASS_KG)})\.?"
    rf"(?:\s*/\s*|\s*\bper\b\s*|\s+pro\s+|\s+par\s+|\s+por\s+|\s+al\s+|\s*[.*]\s*|\s+)(?:a\s+)?"
    rf"({_alternatives(TIME_DAYS)})\.?(?:\s*\^?\s*-\s*1)?(?![\p{{L}}\p{{N}}])"
)
_NUMBER = r"[+-]?(?:\d{1,3}(?:[ ,   '’]\d{3})+(?:\.\d+)?|\d{1,3}(?:\.\d{3})+,\d+|\d{1,3}(?:\.\d{3}){2,}|\d+(?:[.,]\d+)?|[.,]\d+)(?:[eE][+-]?\d+)?"

_LEAD = r"\s*(?:[\p{L} ]{1,30}[:=]\s*)?(?:(?:ca|circa|approx|about|etwa|env|aprox|um|c)\.?\s*|[~≈<>=±]\s*)*"


def _plain(text: Column) -> Column:
    """Text in which every unit is written with plain letters, spaces, / and ^."""
    t = F.regexp_replace(text, r"(?<![\p{L}])Mg(?![\p{L}])", " megagram ")
    for sign, plain in _SIGNS.items():
        t = F.regexp_replace(t, sign, plain.replace("^", "\\^"))
    t = F.regexp_replace(t, r"\^-\^1", "^-1")
    t = F.translate(t, "·⋅•∙×−–—‐_[](){}|:;", "    x----          ")
    return F.regexp_replace(fold_accents(t), r"\s+", " ")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _lookup(word: Column, table: dict) -> Column:
    pairs = [F.lit(x) for factor, names in table.items() for name in names.split() for x in (name, factor)]
    return F.element_at(F.create_map(*pairs), F.regexp_replace(F.trim(word), r"[\s-]+", "-"))


def parse_mass_rate(text: Column) -> Column:
    """struct<kg, days> of the first unit of mass per time in a text: kilograms in one unit, days of its time (0: a
    calendar month); null where the text is null or states none. A yield (mass per area and time), a concentration
    or a mass per event is none."""

    def unit(found: Column) -> Column:
        multiplier, mass, time = (F.regexp_extract(found, _UNIT, i) for i in (1, 2, 3))
        kind = F.regexp_replace(multiplier, r"[\s^*]", "")
        times = F.when(kind == "", F.lit(1.0)).when(kind.isin("103", "1e3", "1000") | kind.rlike("^(thou|mil|mille|milliers|miles|tau)(?!li)"), F.lit(1e3)).otherwise(F.lit(1e6))
        return F.when(mass != "", F.struct((_lookup(mass, MASS_KG) * times).alias("kg"), _lookup(time, TIME_DAYS).alias("days")))

    return F.when(text.isNotNull(), _let(_plain(text), lambda t: _let(F.regexp_extract(t, _UNIT, 0), unit)))


def other_quantity(text: Column) -> Column:
    """Whether a text states a unit of another quantity: a concentration, a discharge, a yield, turbidity, a mass per event."""
    t = _plain(text)
    hit = t.rlike(r"(?<![\p{L}])(?:[kmuµ]?g|t)\s*/?\s*(?:l|m\s?\^?3|dm3)(?:-1|\^-1)?(?![\p{L}\p{N}])|\bm\s?\^?3\s*/?\s*(?:s|h|d|yr|a)\b|\bntu\b|\bfnu\b|\bppm\b|km\s?\^?-?2|/\s*ha\b|/\s*event\b|per event")
    return F.coalesce(hit, F.lit(False))


def leading_number(text: Column) -> Column:
    """The number at the start of a text (after a sign for about or a currency-like word), as double; else null."""
    def value(n: Column) -> Column:
        european = n.rlike(r"^[+-]?\d{1,3}(\.\d{3})+,\d+") | n.rlike(r"^[+-]?\d{1,3}(\.\d{3}){2,}")
        grouped = n.rlike(r"^[+-]?\d{1,3}(,\d{3})+(\.\d+)?([eE]|$)")
        plain = F.when(european, F.translate(F.translate(n, ".", ""), ",", ".")).when(grouped, F.translate(n, ",", "")).otherwise(F.translate(n, ",", "."))
        return F.when(n != "", plain).try_cast("double")

    found = F.regexp_extract(text, rf"^{_LEAD}({_NUMBER})(?![\p{{L}}\p{{N}}])", 1)
    return _let(F.regexp_replace(found, r"[\s   '’]", ""), value)


def after_number(text: Column) -> Column:
    """What follows the leading number of a text."""
    return F.regexp_replace(text, rf"^{_LEAD}{_NUMBER}(?![\p{{L}}\p{{N}}])", " ")


def per_day(unit: Column, date: Column) -> Column:
    """Kilograms a day that one of ``unit`` stands for on ``date``; a calendar month has the days of that month."""
    days = F.when(unit["days"] == 0, F.day(F.last_day(date)).cast("double")).otherwise(unit["days"])
    return unit["kg"] / days
