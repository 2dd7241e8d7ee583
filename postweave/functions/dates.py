"""Dates written in many ways: the signature of a text picks the format, and the fields are cut out of it.

A signature keeps the marks of a text, writes every digit as 0, and names and half-days as one sign each. Formats are
turned into the signatures that they can have, and into the places of their fields among the runs of digits. So a text is
scanned a few times whatever the number of formats, no parser sees a text that it would refuse, and nothing throws.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postweave.functions.text import strip

# Date formats tried after the ISO forms, in this order (month before day).
DATETIME_FORMATS = (
    "yyyy/M/d",
    "yyyy/M/d H:mm",
    "yyyy/M/d H:mm:ss",
    "yyyy.M.d",
    "yyyy.M.d H:mm",
    "yyyy.M.d H:mm:ss",
    "M/d/yyyy",
    "M/d/yyyy H:mm",
    "M/d/yyyy H:mm:ss",
    "M/d/yyyy h:mm a",
    "M/d/yyyy h:mm:ss a",
    "M.d.yyyy",
    "M.d.yyyy H:mm",
    "M.d.yyyy H:mm:ss",
    "M-d-yyyy",
    "M-d-yyyy H:mm",
    "M-d-yyyy H:mm:ss",
    "d-MMM-yyyy",
    "yyyyMMdd",
    "yyyyMMdd HHmmss",
    "d MMM yyyy",
    "d MMM yyyy H:mm",
    "d MMM yyyy H:mm:ss",
    "d MMMM yyyy",
    "MMM d, yyyy",
    "MMM d, yyyy h:mm a",
    "MMMM d, yyyy",
    "MMMM d, yyyy h:mm a",
    "MMM d H:mm:ss yyyy",
)

# What may stand around a date without changing it: the weekday, offsets, the T of compact times.
WEEKDAY = r"(?i)^(mon|tues?|wed(nes)?|thu(rs?)?|fri|sat(ur)?|sun)(day)?,?\s+"
OFFSET = r"(?i)\s+(gmt|utc|z|(gmt|utc)?[+-]\d\d:?\d\d)(?=$|\s)"
COMPACT = r"^(\d{8})T(\d{6})$"
HALF_DAY = r"(?i)(?<![a-z])([ap])m(?![a-z])"
NAME = r"[A-Za-z]+"

# Names of months.
MONTHS = "january february march april may june july august september october november december".split()
SHORT_MONTHS = [m[:3] for m in MONTHS]

# The span of a 64-bit nanosecond clock around 1970; other times count as unparsed.
MAX_EPOCH_SECONDS = 9223372036
FIRST_TIME = "1677-09-21 00:12:44"
LAST_TIME = "2262-04-11 23:47:16"

# Units of epoch numbers, in microseconds.
EPOCH_UNITS = {"day": 86_400e6, "hour": 3600e6, "minute": 60e6, "second": 1e6, "milli": 1e3, "micro": 1.0, "nano": 1e-3}

# Signs of a signature.
HALF_SIGN, NAME_SIGN = "\x01", "\x02"
NUMBERS = "yMdHhmsS"


def in_clock_range(c: Column) -> Column:
    low, high = (F.lit(t).cast("timestamp_ntz") for t in (FIRST_TIME, LAST_TIME))
    return F.when(c.between(low, high), c)


def epoch_time(number: Column, unit: str) -> Column:
    """A number of one of EPOCH_UNITS since 1970 as time without zone."""
    each = EPOCH_UNITS[unit]
    in_range = F.abs(number) <= F.lit(MAX_EPOCH_SECONDS * 1e6 / each)
    scaled = number * F.lit(int(each)) if each >= 1 else number / F.lit(round(1 / each))
    return F.when(in_range, F.timestamp_micros(F.when(in_range, F.round(scaled).cast("long"))).cast("timestamp_ntz"))


def unquote(c: Column) -> Column:
    """Date text without white space and surrounding quotes, first double, then single ones."""
    return F.regexp_replace(F.regexp_replace(strip(c), '^"+|"+$', ""), "^'+|'+$", "")


def day_first(formats: Sequence[str] = DATETIME_FORMATS) -> tuple[str, ...]:
    """The same formats with day before month where both are numbers."""
    return tuple(re.sub(r"^(M+)([/.-])(d+)(?=\2)", r"\3\2\1", f) if not f.startswith("MMM") else f for f in formats)


def layouts(date_format: str) -> list[tuple[str, dict[str, tuple[int, int, int]]]]:
    """All signatures of a format, each with the places of its fields: run of digits, first digit, digits.

    A single letter stands for one or two digits, more letters for as many. ``MMM`` and ``MMMM`` are names of months (field
    ``N``: place among the names, letters in the format, nothing), ``E`` names of weekdays, ``a`` half-days.
    """
    parts = re.findall(r"([A-Za-z])(\1*)|([^A-Za-z]+)", date_format)
    widths = []
    for letter, more, _ in parts:
        number = letter and letter in NUMBERS and not (letter == "M" and len(more) > 1)
        if letter and not number and letter not in "MEa":
            raise ValueError(f"{date_format}: letter {letter} of a date format is not known")
        widths.append(((1, 2) if not more else (1 + len(more),)) if number else (0,))
    found = []
    for chosen in product(*widths):
        signature, places, run, within, names = "", {}, -1, 0, 0
        for (letter, more, mark), width in zip(parts, chosen):
            if width:
                if not signature.endswith("0"):
                    run, within = run + 1, 0
                places[letter] = (run, within, width)
                signature, within = signature + "0" * width, within + width
            elif mark:
                # Digits among the marks make or lengthen a run, too.
                for c in mark:
                    if c.isdigit():
                        run, within = (run, within) if signature.endswith("0") else (run + 1, 0)
                        within += 1
                    signature += "0" if c.isdigit() else c
            elif letter == "a":
                signature += HALF_SIGN
                places["a"] = (0, 0, 0)
            else:
                if letter == "M":
                    places["N"] = (names, 1 + len(more), 0)
                signature, names = signature + NAME_SIGN, names + 1
        # A run that is one field only is taken whole, whatever its width.
        alone = [r for r in range(run + 1) if sum(p[0] == r and letter != "N" for letter, p in places.items()) == 1]
        whole = {k: (p[0], 0, 0) if p[2] and p[1] == 0 and p[0] in alone and not (k == "y" and p[2] == 2) and k != "S" else p for k, p in places.items()}
        found.append((signature, whole if not any(c.isdigit() for _, _, mark in parts for c in mark) else places))
    return found


def _choices(formats: Sequence[str]) -> list[list[tuple[list[str], dict]]]:
    """Layers of layouts with their signatures. A signature of several layouts has the first in the first layer, and so on."""
    depth: dict[str, int] = {}
    layers: list[dict[str, tuple[list[str], dict]]] = []
    for date_format in dict.fromkeys(formats):
        for signature, places in layouts(date_format):
            level = depth.get(signature, 0)
            depth[signature] = level + 1
            if level == len(layers):
                layers.append({})
            layers[level].setdefault(repr(sorted(places.items())), ([], places))[0].append(signature)
    return [list(layer.values()) for layer in layers]


def _bare(text: Column) -> Column:
    """A date text without weekday and offset, compact times spread. Each pattern is tried only where it may be found."""
    bare = F.when(F.ascii(text) >= ord("A"), F.regexp_replace(text, WEEKDAY, "")).otherwise(text)
    bare = F.when(text.contains(" "), F.regexp_replace(bare, OFFSET, "")).otherwise(bare)
    return F.when(F.length(text) == 15, F.regexp_replace(bare, COMPACT, "$1 $2")).otherwise(bare)


def _text_literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _of_layout(values: Sequence[float]) -> Column:
    """The value that belongs to the chosen layout. One expression, as a column for each value takes long to plan."""
    return F.expr(f"get(array({', '.join(map(str, values))}), _layout)")


def _field(layer: list[tuple[list[str], dict]], letter: str, default: int | None) -> Column:
    """The number that the chosen layout has for a letter."""
    runs, firsts, widths = ([places.get(letter, (-1, 0, 0))[k] for _, places in layer] for k in range(3))
    run = F.get(F.col("_digits"), _of_layout(runs))
    if any(widths):
        part = F.substr(run, _of_layout(firsts) + 1, _of_layout(widths))
        run = F.when(_of_layout(widths) > 0, part).otherwise(run)
    number = run.cast("int")
    if letter == "y" and 2 in widths:
        number = F.when(_of_layout(widths) == 2, number + 2000).otherwise(number)
    if all(letter in places for _, places in layer):
        return number
    return F.when(_of_layout(runs) >= 0, number).otherwise(F.lit(default).cast("int"))


def _month(layer: list[tuple[list[str], dict]]) -> Column:
    if not any("N" in places for _, places in layer):
        return _field(layer, "M", 1)
    places_of, letters = ([places.get("N", (-1, 0))[k] for _, places in layer] for k in range(2))
    name = F.lower(F.get(F.col("_names"), _of_layout(places_of)))
    short, long = (F.expr(f"array({', '.join(map(_text_literal, names))})") for names in (SHORT_MONTHS, MONTHS))
    by_name = F.when(_of_layout(letters) == 3, F.array_position(short, name)).otherwise(F.array_position(long, name))
    return F.when(_of_layout(places_of) >= 0, by_name.cast("int")).otherwise(_field(layer, "M", 1))


def _time(layer: list[tuple[list[str], dict]]) -> Column:
    """The time of the chosen layout, null where a field is out of range."""
    has = lambda letter: any(letter in places for _, places in layer)
    hour = _field(layer, "H", 0)
    if has("h"):
        twelve = _field(layer, "h", None)
        late = F.when(F.lower(F.col("_half")) == "p", 12).otherwise(0)
        of_half = F.when(twelve.between(1, 12), twelve % 12 + late).otherwise(F.lit(99))
        hour = F.when(twelve.isNotNull(), of_half).otherwise(hour)
    second = _field(layer, "s", 0).cast("decimal(16,6)")
    if has("S"):
        shares = [f"{10.0 ** -places.get('S', (0, 0, 0))[2]}D" for _, places in layer]
        second = (second + _field(layer, "S", 0) * _of_layout(shares)).cast("decimal(16,6)")
    whole = F.try_make_timestamp_ntz(_field(layer, "y", 1970), _month(layer), _field(layer, "d", 1), hour, _field(layer, "m", 0), second)
    # 60 seconds would count as the next minute.
    return F.when(second < 60, whole)


def with_parsed_datetime(df: DataFrame, text: str, name: str, formats: Sequence[str] = DATETIME_FORMATS) -> DataFrame:
    """Add ``name``: unquoted date text as time without zone, by ISO forms and then each declared format in turn.

    Offsets are left out as they are in ISO texts, so the time is that of the writer. Each step reads columns of the one
    before, which are made once, and the result comes out of an inline of one row: a filter on it must not carry copies
    of the steps below the projection.
    """
    kept = df.columns
    steps = df.withColumn("_bare", _bare(F.col(text)))
    # Texts without letters have neither names nor half-days.
    steps = steps.withColumn("_lettered", F.col("_bare").rlike("[A-Za-z]"))
    half = F.when(F.col("_lettered"), F.regexp_replace(F.col("_bare"), HALF_DAY, HALF_SIGN)).otherwise(F.col("_bare"))
    steps = steps.withColumn("_halved", half)
    marked = F.when(F.col("_lettered"), F.regexp_replace("_halved", NAME + r"\.?", NAME_SIGN)).otherwise(F.col("_halved"))
    steps = steps.withColumn("_signature", F.translate(marked, "123456789", "000000000"))
    layers = _choices(formats)
    found = []
    for k, layer in enumerate(layers):
        cases = (f"WHEN _signature IN ({', '.join(map(_text_literal, signatures))}) THEN {n}" for n, (signatures, _) in enumerate(layer))
        steps = steps.withColumn(f"_layout{k}", F.expr(f"CASE {' '.join(cases)} END"))
        found.append(f"_layout{k}")
    some = F.coalesce(*(F.col(c) for c in found)).isNotNull() if found else F.lit(False)
    cut = {
        "_digits": F.when(some, F.split(F.regexp_replace("_bare", "^[^0-9]+", ""), "[^0-9]+")),
        "_names": F.when(some & F.col("_lettered"), F.split(F.regexp_replace("_halved", "^[^A-Za-z]+", ""), "[^A-Za-z]+")),
        "_half": F.when(some & F.col("_lettered"), F.regexp_extract("_bare", HALF_DAY, 1)),
    }
    steps = steps.withColumns(cut)
    times = [F.col(text).try_cast("timestamp_ntz")]
    for k, layer in enumerate(layers):
        steps = steps.withColumn("_layout", F.col(f"_layout{k}")).withColumn(f"_time{k}", F.when(F.col("_layout").isNotNull(), _time(layer)))
        times.append(F.col(f"_time{k}"))
    parsed = F.struct(F.coalesce(*times).alias(name))
    return steps.select(*(F.col(f"`{c}`") for c in kept), F.inline(F.array(parsed)))
