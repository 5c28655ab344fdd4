"""Column parsers for dates, prices and dimensions. Each returns a struct with a status."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from atelier.functions.text import let

#: Currency by symbol.
SYMBOLS = {"$": "USD", "£": "GBP", "€": "EUR", "¥": "JPY"}
CODES = ["USD", "GBP", "EUR", "JPY", "ZAR", "CHF", "AUD", "CAD"]


def _int(c: Column) -> Column:
    return F.nullif(c, F.lit("")).cast("int")


def year_parse(c: Column) -> Column:
    year = F.when(c.rlike(r"^[0-9]{4}\z"), _int(F.regexp_extract(c, "^([0-9]{4})", 1)))
    return F.struct(year.alias("year_start"), year.alias("year_end"), F.when(c.isNull(), "missing").when(year.isNotNull(), "parsed").otherwise("failed").alias("status"))


def lifespan_year(c: Column) -> Column:
    return _int(F.regexp_extract(F.coalesce(c, F.lit("")), r"\b(1[5-9][0-9]{2}|20[0-9]{2})\b", 1))


def date_parse_full(c: Column) -> Column:
    """Year, circa, range, century and part of a century."""
    t = F.lower(F.trim(c))
    one = _int(F.regexp_extract(t, r"^(?:c\.?|ca\.?|circa)?\s*([0-9]{4})\z", 1))
    a = _int(F.regexp_extract(t, r"^(?:c\.?|ca\.?|circa)?\s*([0-9]{4})\s*[-–/]\s*([0-9]{4})\z", 1))
    b = _int(F.regexp_extract(t, r"^(?:c\.?|ca\.?|circa)?\s*([0-9]{4})\s*[-–/]\s*([0-9]{4})\z", 2))
    pattern = r"^(early|mid|late)?[\s-]*([0-9]{1,2})(?:st|nd|rd|th) century\z"
    century, part = _int(F.regexp_extract(t, pattern, 2)), F.regexp_extract(t, pattern, 1)
    base = (century - 1) * 100
    lo = base + F.when(part == "late", 67).when(part == "mid", 34).otherwise(0)
    hi = base + F.when(part == "early", 33).when(part == "mid", 66).otherwise(99)
    status = F.when(c.isNull(), "missing").when(one.isNotNull(), "parsed").when(a.isNotNull(), "range_parsed").when(century.isNotNull(), "century_parsed").otherwise("failed")
    return F.struct(F.coalesce(one, a, lo).alias("year_start"), F.coalesce(one, b, hi).alias("year_end"), status.alias("status"))


_DAY = r"([0-9]{1,2} [A-Za-z]{3,9} [0-9]{4})"


_MONTHS = "january february march april may june july august september october november december".split()


def _date(c: Column) -> Column:
    """The date of "12 March 2024" or "12 Mar 2024"; null for anything else. Months are looked up, as a failing format costs an exception a row."""
    months = ", ".join(f"'{name}', '{i:02}'" for i, m in enumerate(_MONTHS, 1) for name in dict.fromkeys((m, m[:3])))

    def of(parts: Column) -> Column:
        month = F.try_element_at(F.expr(f"map({months})"), F.lower(F.get(parts, F.lit(1))))
        return F.concat(F.get(parts, F.lit(2)), F.lit("-"), month, F.lit("-"), F.get(parts, F.lit(0))).try_cast("date")

    return F.when(c.isNotNull(), let(F.split(c, " "), of))


def date_range_parse(c: Column) -> Column:
    """struct of start and end from "12 March 2024 - 3 May 2024" or a single date."""
    both = rf"{_DAY}\s*[-–—]\s*{_DAY}"

    def of(t: Column) -> Column:
        day = lambda r, i: F.when(r != "", _date(F.regexp_extract(r, both, i)))
        start = lambda r: F.coalesce(day(r, 1), _date(F.regexp_extract(t, _DAY, 1)))
        # a text is searched for a range once; its days are read from what was found
        return let(F.regexp_extract(t, both, 0), lambda r: let(start(r), lambda x: F.struct(x.alias("start_date"), F.coalesce(day(r, 2), x).alias("end_date"))))

    return let(F.trim(F.regexp_replace(c, r"\s+", " ")), of)


def opening_datetime_parse(c: Column) -> Column:
    """UTC time of "opening ... 12 March 2024 [at] 6:30 pm" or with a 24 h time; midnight without one."""
    pattern = rf"(?i)opening[^0-9]*{_DAY}(?:,?(?: at)? ([0-9]{{1,2}})(?:[:.]([0-9]{{2}}))? ?(am|pm)?)?"

    def of(t: Column) -> Column:
        day = _date(F.regexp_extract(t, pattern, 1))
        hour, minute, half = _int(F.regexp_extract(t, pattern, 2)), _int(F.regexp_extract(t, pattern, 3)), F.lower(F.regexp_extract(t, pattern, 4))
        hour = F.when(half == "pm", hour % 12 + 12).when(half == "am", hour % 12).otherwise(hour)
        return F.when(t != "", day.cast("timestamp") + F.make_dt_interval(F.lit(0), F.coalesce(hour, F.lit(0)), F.coalesce(minute, F.lit(0))))

    return let(F.regexp_extract(F.regexp_replace(c, r"\s+", " "), pattern, 0), of)


def price_status(c: Column) -> Column:
    low = F.lower(c)
    return F.when(c.isNull(), "missing").when(F.contains(low, F.lit("price on request")), "price_on_request").when(F.contains(low, F.lit("sold")), "not_available").otherwise("failed")


def price_parse(c: Column, *, default: str | None = None) -> Column:
    """struct of min, max, currency and status. Currency: code, then symbol, then default."""
    low = F.lower(F.trim(c))
    numbers = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"[0-9]{1,3}(?:,[0-9]{3})+(?:\.[0-9]{1,2})?|[0-9]+(?:\.[0-9]{1,2})?"), F.lit(0))
    values = F.transform(numbers, lambda n: F.regexp_replace(n, ",", "").cast("decimal(18,2)"))
    first, second = F.try_element_at(values, F.lit(1)), F.try_element_at(values, F.lit(2))
    ranged = second.isNotNull() & c.rlike("[-–]| to ")
    code = F.nullif(F.regexp_extract(F.upper(F.coalesce(c, F.lit(""))), rf"\b({'|'.join(CODES)})\b", 1), F.lit(""))
    symbol = F.coalesce(*(F.when(F.contains(c, F.lit(s)), F.lit(k)) for s, k in SYMBOLS.items()))
    status = (
        F.when(c.isNull(), "missing")
        .when(low.rlike("on request|enquire|poa"), "price_on_request")
        .when(low.rlike("sold|not for sale|nfs"), "not_available")
        .when(ranged, "range_parsed")
        .when(first.isNotNull(), "parsed")
        .otherwise("failed")
    )
    good = status.isin("parsed", "range_parsed")
    return F.struct(
        F.when(good, first).alias("price_min"), F.when(good, F.when(ranged, second).otherwise(first)).alias("price_max"), F.when(good, F.coalesce(code, symbol, F.lit(default))).alias("currency"), status.alias("status")
    )


_NUMBER = r"([0-9]+(?:\.[0-9]+)?(?:\s+[0-9]+/[0-9]+)?|[0-9]+/[0-9]+)"


def _measure(c: Column) -> Column:
    """Decimal of "10", "10.5", "10 1/2" or "1/2"."""

    def of(c: Column) -> Column:
        whole = F.nullif(F.regexp_extract(c, r"^([0-9]+(?:\.[0-9]+)?)(?:\s|\z)", 1), F.lit("")).cast("decimal(18,4)")
        top, under = _int(F.regexp_extract(c, "([0-9]+)/([0-9]+)", 1)), _int(F.regexp_extract(c, "([0-9]+)/([0-9]+)", 2))
        part = F.when(F.contains(c, F.lit("/")) & (under > 0), top.cast("decimal(18,4)") / under)
        return let(F.struct(whole.alias("whole"), part.alias("part")), lambda x: F.when(x["whole"].isNull() & x["part"].isNull(), None).otherwise(F.coalesce(x["whole"], F.lit(0)) + F.coalesce(x["part"], F.lit(0))))

    return let(c, of)


def dimension_parse(c: Column) -> Column:
    """struct of height, width, depth in cm and status, from "H x W (x D)" in cm or inches. A text is searched once; its measures are read from what was found."""
    pattern = rf"{_NUMBER}\s*(?:cm|in|\")?\s*[x×]\s*{_NUMBER}(?:\s*(?:cm|in|\")?\s*[x×]\s*{_NUMBER})?"

    def found(t: Column) -> Column:
        def measures(m: Column) -> Column:
            h, w, d = (_measure(F.when(m != "", F.nullif(F.regexp_extract(m, pattern, i), F.lit("")))) for i in (1, 2, 3))
            return F.struct(h.alias("h"), w.alias("w"), d.alias("d"))

        unit = F.when(t.rlike(r"\bin\b|inch|[0-9]\s*\""), F.lit("in")).when(t.rlike(r"cm\b"), F.lit("cm"))
        single = _measure(F.nullif(F.regexp_extract(t, rf"^{_NUMBER}\s*(?:cm|in|inches|\")", 1), F.lit("")))
        first = lambda m: F.coalesce(m["h"], single)
        both = lambda m: F.struct(first(m).alias("first"), m["h"].isNotNull().alias("sized"), m["w"].alias("w"), m["d"].alias("d"), unit.alias("unit"))
        return let(let(let(F.regexp_extract(t, pattern, 0), measures), both), done)

    def done(x: Column) -> Column:
        scale = F.when(x["unit"] == "in", F.lit("2.54")).otherwise("1").cast("decimal(4,2)")
        cm = lambda v: F.round(v * scale, 2).cast("decimal(18,2)")
        good = x["first"].isNotNull()
        status = F.when(x["sized"] & x["w"].isNotNull() & x["unit"].isNotNull(), "parsed").when(good, "partial").otherwise("failed")
        return F.struct(cm(x["first"]).alias("height_cm"), F.when(good, cm(x["w"])).alias("width_cm"), F.when(good, cm(x["d"])).alias("depth_cm"), x["unit"].alias("unit"), status.alias("status"))

    nothing = F.struct(*(F.lit(None).cast("decimal(18,2)").alias(f"{n}_cm") for n in ("height", "width", "depth")), F.lit(None).cast("string").alias("unit"), F.lit("missing").alias("status"))
    return F.when(c.isNull(), nothing).otherwise(let(F.lower(F.trim(c)), found))
