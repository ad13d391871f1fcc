"""Personal numbers, dates and addresses replaced by keyed pseudonyms of the same format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8

# What may be personal, in the order in which it is tried at a place of the text.
# Account numbers have a length by country, so that a word after one isn't taken for a part of it.
LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
IBAN = "|".join(
    rf"(?<![A-Za-z0-9])(?:{own.replace(' ', '|')})\d{{2}}(?: ?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}"
    + (rf" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") + "(?![A-Za-z0-9])"
    for n, own in LENGTHS.items()
) + r"|(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
EMAIL = r"(?<![\w.%+-])[A-Za-z0-9][\w.%+-]*+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
ADDRESS = r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)"
ISO_DATE = r"(?<![\d-])\d{4}-\d{2}-\d{2}(?![\d-])"
DATE = r"(?<![\d./-])\d{2}([/.])\d{2}\1\d{4}(?!\d)"
SOCIAL = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
PHONE = (
    r"(?<![\d+])(?:\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\d)|\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}"
    r"|\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?!\d)"
)
PLAIN_DATE = DATE.replace(r"([/.])", "[/.]").replace(r"\1", "[/.]")
OTHER = "|".join([ADDRESS, ISO_DATE, PLAIN_DATE, SOCIAL, PHONE])
#: All neighbouring digits up to where something else begins; the cards are looked for inside.
CARD = rf"(?<!\d)\d(?:(?:[ -](?!{OTHER}))?\d){{12,}}+"
CARD_FORM = r"^(\d{13,19}|\d{4}([ -])\d{4}\2\d{4}\2\d{4}(\2\d{1,3})?|\d{4}([ -])\d{6}\4\d{4,5})$"
ANY = "|".join([IBAN, EMAIL, OTHER, CARD])


def _keyed(key: str, label: str | Column, step: Column, half: Column, size: Column) -> Column:
    """A number below `size` from a keyed hash of one half."""
    label = F.lit(label) if isinstance(label, str) else label
    said = F.concat(F.lit(f"{key}|"), label, F.lit("|"), step.cast("string"), F.lit("|"), half.cast("string"))
    return F.conv(F.substring(F.sha2(said, 256), 1, 15), 16, 10).cast("long") % size


def feistel(key: str, label: str | Column, left: Column, right: Column, lefts: Column, rights: Column) -> Column:
    """struct(l, r): a keyed permutation of the pairs (left < lefts, right < rights).

    Each round adds to one half what the other says, modulo that half's size; this can be undone,
    so no two pairs meet, and no value leaves the format.
    """

    other = label + "+" if isinstance(label, str) else F.concat(label, F.lit("+"))

    def step(state: Column, i: Column) -> Column:
        left = (state["l"] + _keyed(key, label, i, state["r"], lefts)) % lefts
        return F.struct(left.alias("l"), ((state["r"] + _keyed(key, other, i, left, rights)) % rights).alias("r"))

    rounds = F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(rounds, F.struct(left.cast("long").alias("l"), right.cast("long").alias("r")), step)


def _power(n: Column) -> Column:
    """10 to the power n, 0 <= n <= 10."""
    return F.element_at(F.array(*[F.lit(10**i).cast("long") for i in range(11)]), (n + 1).cast("int"))


def _let(value: Column, body) -> Column:
    """`body` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _permuted(key: str, label: str | Column, digits: Column) -> Column:
    """A string of 2 to 19 digits permuted among those of its length."""
    n = F.length(digits)
    half = F.floor(n / 2).cast("int")
    rest = n - half
    pair = feistel(
        key, label, F.substring(digits, F.lit(1), half), F.substring(digits, half + 1, rest), _power(half), _power(rest)
    )
    return _let(pair, lambda p: F.concat(F.lpad(p["l"].cast("string"), half, "0"), F.lpad(p["r"].cast("string"), rest, "0")))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _refilled(form: Column, digits: Column) -> Column:
    """`form` with its digits replaced, in order."""

    def char(i: Column) -> Column:
        own = F.substring(form, i, F.lit(1))
        before = F.length(_digits(F.substring(form, F.lit(1), i - 1)))
        return F.when(own.rlike("[0-9]"), F.substring(digits, before + 1, F.lit(1))).otherwise(own)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(form)), char), "")


def _luhn(digits: Column) -> Column:
    """The Luhn sum of digits that end in the check digit."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        double = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when((n - i) % 2 == 1, double).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def _card(key: str, found: Column) -> Column:
    """Luhn-valid numbers stay Luhn-valid; others are left alone."""

    def permuted(digits: Column) -> Column:
        body = _permuted(key, "card", F.substring(digits, F.lit(1), F.length(digits) - 1))
        closed = _let(body, lambda b: F.concat(b, ((10 - _luhn(F.concat(b, F.lit("0"))) % 10) % 10).cast("string")))
        return F.when(_is_card(digits), _let(closed, lambda c: _refilled(found, c))).otherwise(found)

    return _let(_digits(found), permuted)


def _is_card(digits: Column) -> Column:
    return F.length(digits).between(13, 19) & (_luhn(digits) % 10 == 0)


def _card_parts(run: Column) -> Column:
    """A run of digits in parts: whole cards, and what is around them.

    Left to right, whole groups that have the form of a card and pass its check are one. Only if there
    are none, any other grouping counts: at each place as many groups as have 19 digits at most.
    """

    def parts(groups: Column, choices) -> Column:
        def step(state: Column, i: Column) -> Column:
            piece = lambda n: F.regexp_replace(F.array_join(F.slice(groups, i, n), ""), "[ -]$", "")
            taken = _let(
                F.coalesce(F.get(choices(groups, i, piece), F.lit(0)), F.lit(1)),
                lambda n: F.struct(
                    (i + n).alias("next"),
                    F.concat(state["parts"], F.array(piece(n), F.regexp_extract(F.element_at(groups, i + n - 1), "[ -]$", 0))).alias("parts"),
                ),
            )
            return F.when(i < state["next"], state).otherwise(taken)

        start = F.struct(F.lit(1).alias("next"), F.array().cast("array<string>").alias("parts"))
        return F.aggregate(F.sequence(F.lit(1), F.size(groups)), start, step, lambda state: state["parts"])

    def formed(groups: Column, i: Column, piece) -> Column:
        fits = lambda n: piece(n).rlike(CARD_FORM) & _is_card(_digits(piece(n)))
        return F.filter(F.array(*[F.lit(n) for n in (1, 4, 5, 3)]), lambda n: (i + n - 1 <= F.size(groups)) & fits(n))

    def longest(groups: Column, i: Column, piece) -> Column:
        fits = lambda n: F.length(_digits(piece(n))).between(13, 19)
        return F.filter(F.sequence(F.lit(19), F.lit(1)), lambda n: (i + n - 1 <= F.size(groups)) & fits(n))

    def chosen(groups: Column) -> Column:
        first = lambda p: F.when(F.exists(p, lambda x: x.rlike(CARD_FORM) & _is_card(_digits(x))), p)
        return _let(parts(groups, formed), lambda p: F.coalesce(first(p), parts(groups, longest)))

    return _let(F.regexp_extract_all(run, F.lit(r"\d+[ -]?"), F.lit(0)), chosen)


def _address(key: str, found: Column) -> Column:
    parts = F.transform(F.split(found, r"\."), lambda p: p.cast("long"))

    def permuted(p: Column) -> Column:
        size = F.lit(65536).cast("long")
        pair = feistel(key, "address", p[0] * 256 + p[1], p[2] * 256 + p[3], size, size)
        written = _let(pair, lambda q: F.concat_ws(
            ".", F.floor(q["l"] / 256).cast("string"), (q["l"] % 256).cast("string"),
            F.floor(q["r"] / 256).cast("string"), (q["r"] % 256).cast("string"),
        ))
        return F.when(F.array_max(p) <= 255, written).otherwise(found)

    return _let(parts, permuted)


FIRST_DAY, DAYS = "1900-01-01", 73049  # up to 2099-12-31; 73049 = 17 * 4297


def _other_day(key: str, day: Column) -> Column:
    index = F.datediff(day, F.lit(FIRST_DAY).cast("date")).cast("long")
    pair = feistel(key, "date", index % 17, F.floor(index / 17), F.lit(17).cast("long"), F.lit(4297).cast("long"))
    moved = _let(pair, lambda p: F.date_add(F.lit(FIRST_DAY).cast("date"), (p["r"] * 17 + p["l"]).cast("int")))
    inside = (day >= F.lit(FIRST_DAY).cast("date")) & (day <= F.lit("2099-12-31").cast("date"))
    return F.when(inside, moved)


def _date(key: str, found: Column) -> Column:
    """Years 1900 to 2099, as yyyy-mm-dd or with day and month first; day first if both are possible."""
    iso = found.rlike("-")
    first, second, year = F.substring(found, 1, 2), F.substring(found, 4, 2), F.substring(found, 7, 4)
    month_first = ~iso & (second > "12")
    day = F.when(iso, found).otherwise(F.concat_ws(
        "-", year, F.when(month_first, first).otherwise(second), F.when(month_first, second).otherwise(first)
    )).try_cast("date")
    sep = F.substring(found, 3, 1)

    def written(d: Column) -> Column:
        dd, mm, yyyy = F.date_format(d, "dd"), F.date_format(d, "MM"), F.date_format(d, "yyyy")
        return (
            F.when(iso, F.concat_ws("-", yyyy, mm, dd))
            .when(month_first, F.concat(mm, sep, dd, sep, yyyy))
            .otherwise(F.concat(dd, sep, mm, sep, yyyy))
        )

    return _let(_other_day(key, day), lambda d: F.when(d.isNull(), found).otherwise(written(d)))


def _social(key: str, found: Column) -> Column:
    """Areas 001 to 899 but 666, groups 01 to 99, serials 0001 to 9999; others are left alone."""
    area, group, serial = (F.substring(found, at, n).cast("long") for at, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    place = F.when(area > 666, area - 2).otherwise(area - 1)
    pair = feistel(
        key, "social", place, (group - 1) * 9999 + serial - 1, F.lit(898).cast("long"), F.lit(99 * 9999).cast("long")
    )

    def written(p: Column) -> Column:
        own = F.when(p["l"] >= 665, p["l"] + 2).otherwise(p["l"] + 1)
        two = [own, F.floor(p["r"] / 9999) + 1, p["r"] % 9999 + 1]
        return F.concat_ws("-", *[F.lpad(x.cast("string"), n, "0") for x, n in zip(two, (3, 2, 4), strict=True)])

    return F.when(valid, _let(pair, written)).otherwise(found)


def _phone(key: str, found: Column) -> Column:
    """Numbers of 10 to 15 digits; the country code stays."""
    code = F.regexp_extract(found, r"^\+(1|7|\d\d)", 1)

    def permuted(digits: Column) -> Column:
        own = F.substring(digits, F.length(code) + 1, F.length(digits))
        valid = (F.length(digits) >= 10) & (F.length(digits) <= 15)
        return F.when(valid, _refilled(found, F.concat(code, _permuted(key, "phone", own)))).otherwise(found)

    return _let(_digits(found), permuted)


def _mod97(text: Column) -> Column:
    """The value of an IBAN's letters and digits modulo 97."""

    def add(rest: Column, char: Column) -> Column:
        code = F.ascii(char)
        return F.when(code >= 65, (rest * 100 + code - 55) % 97).otherwise((rest * 10 + code - 48) % 97)

    return F.aggregate(F.split(text, ""), F.lit(0), lambda r, c: F.when(c == "", r).otherwise(add(r, c)))


def _iban(key: str, found: Column) -> Column:
    """Valid account numbers keep country, letters and spacing; check digits are made anew."""

    def permuted(plain: Column) -> Column:
        country, account = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.length(plain))
        valid = _mod97(F.concat(account, F.substring(plain, 1, 4))) == 1
        numbers = _digits(account)

        def written(own: Column) -> Column:
            check = F.lpad((98 - _mod97(F.concat(own, country, F.lit("00")))).cast("string"), 2, "0")
            return _refilled(found, F.concat(check, _digits(own)))

        # Of more than 19 digits the last 16 are permuted under a key from those before, and then those
        # under a key from the new ones.
        head, tail = F.substring(numbers, F.lit(1), F.length(numbers) - 16), F.substring(numbers, F.length(numbers) - 15, F.lit(16))
        under = lambda digits: F.concat(F.lit("iban|"), digits)
        both = _let(
            _permuted(key, under(head), tail), lambda new: F.concat(_permuted(key, under(new), head), new)
        )
        moved = F.when(F.length(numbers) > 19, both).otherwise(_permuted(key, "iban", numbers))
        return F.when(valid & (F.length(numbers) >= 2), _let(_refilled(account, moved), written)).otherwise(found)

    return _let(F.regexp_replace(found, " ", ""), permuted)


def _shifted(key: str, text: Column, other: Column, step: Column) -> Column:
    """Every letter and digit of `text` moved on within its kind by a hash of the other half."""

    def char(c: Column, i: Column) -> Column:
        code = F.ascii(c)
        moved = lambda low, size: F.chr(low + (code - low + _keyed(key, "mail", step * 1000 + i, other, F.lit(size))) % size)
        return F.when(c.between("a", "z"), moved(97, 26)).when(c.between("0", "9"), moved(48, 10)).otherwise(c)

    return F.array_join(F.transform(F.split(text, ""), char), "")


def _email(key: str, found: Column) -> Column:
    """Letters become letters and digits digits, up to the last label of the host."""
    plain = F.lower(found)
    head = F.regexp_replace(plain, r"\.[^.]*$", "")
    local, host = F.substring_index(head, "@", 1), F.substring_index(head, "@", -1)

    def step(state: Column, i: Column) -> Column:
        left = _shifted(key, state["l"], state["r"], i)
        return F.struct(left.alias("l"), _shifted(key, state["r"], left, i + 50).alias("r"))

    pair = F.aggregate(F.sequence(F.lit(1), F.lit(2)), F.struct(local.alias("l"), host.alias("r")), step)
    moved = _let(pair, lambda p: F.concat(p["l"], F.lit("@"), p["r"], F.regexp_extract(plain, r"\.[^.]*$", 0)))
    return F.when(found == F.upper(found), F.upper(moved)).otherwise(moved)


KINDS = (
    ("email", "@", _email),
    ("iban", "^[A-Z]", _iban),
    ("address", r"^\d{1,3}(\.\d{1,3}){3}$", _address),
    ("date", r"^\d{4}-\d{2}-\d{2}$|^\d{2}[/.]\d{2}[/.]\d{4}$", _date),
    ("social", r"^\d{3}-\d{2}-\d{4}$", _social),
    ("phone", r"^[+(]|^\d{3}[.-]\d{3}[.-]\d{4}$", _phone),
    ("card", r"^\d", _card),
)


def pseudonymised(docs: DataFrame, key: str, originals: bool = False) -> DataFrame:
    """Every row of `docs` with its text replaced and a column `found`: array<struct<kind, pseudonym>> of
    what was replaced, in order; with `originals` also the `value` that each stands for.

    Card numbers (Luhn), account numbers (IBAN), IPv4 addresses, social security numbers, phone
    numbers and dates that pass their checks, and e-mail addresses, become others of the same kind,
    length, punctuation and validity by a Feistel network under `key`. The same value has the same
    pseudonym in every document; without the key it can't be undone. What fails its check stays.

    * A null text stays null and an empty one empty, with nothing found.
    * Repeated rows are treated alike; an empty table is fine.
    * Other columns pass through; a column named `found` must not exist.

    No row leaves its partition: two regular expressions a text, and array functions on the matches.
    """
    if "found" in docs.columns:
        raise ValueError("the documents have a column found already")

    def replaced(value: Column) -> Column:
        kind, out = F.lit("card"), value
        for name, shape, change in reversed(KINDS[:-1]):
            kind = F.when(value.rlike(shape), name).otherwise(kind)
            out = F.when(value.rlike(shape), change(key, value)).otherwise(out)
        one = lambda k, v, o: F.struct(k.alias("kind"), v.alias("value"), o.alias("pseudonym"))
        inside = F.transform(_card_parts(value), lambda v: one(F.lit("card"), v, _card(key, v)))
        return F.when(kind == "card", inside).otherwise(F.array(one(kind, value, out)))

    text = F.col("text")
    matches = F.transform(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), replaced)
    none = F.array().cast("array<array<struct<kind:string,value:string,pseudonym:string>>>")
    rows = docs.withColumn("__hits", F.when(text.rlike(ANY), matches).otherwise(none))
    parts = F.zip_with(
        F.split(text, ANY, -1), F.col("__hits"),
        lambda piece, hit: F.concat(piece, F.coalesce(F.array_join(hit["pseudonym"], ""), F.lit(""))),
    )
    rows = rows.withColumn("text", F.when(F.size("__hits") > 0, F.array_join(parts, "")).otherwise(text))
    changed = F.filter(F.flatten("__hits"), lambda m: m["value"] != m["pseudonym"])
    changed = F.coalesce(changed, F.flatten(none))
    if not originals:
        changed = F.transform(changed, lambda m: F.struct(m["kind"].alias("kind"), m["pseudonym"].alias("pseudonym")))
    return rows.withColumn("found", changed).drop("__hits")
