"""Format-preserving pseudonyms for personal numbers, dates and addresses.

What is found is validated first: payment cards by their Luhn digit, calendar dates by the
calendar, IPv4 octets and social security areas by their ranges, phone numbers by the count
of their digits. A text is scanned several times: for common layouts, for any run that can be a
value, and for layouts inside the runs that were no values, so that a number next to another
one is found. What fails all of them stays as it is. A valid value is mapped by a keyed Feistel
permutation of all values of its format: equal values keep equal pseudonyms in all
documents, different values stay different, and ``restore`` inverts it with the key.

Numbers: two halves in Z_a and Z_b are added modulo a and b in turn, each time a keyed hash
of the other half, so that any domain of a * b values is permuted within itself. Dates are
numbered within their 400-year cycle of 146,097 = 189 * 773 days. The local part of an
e-mail address is permuted letter by letter within upper case, lower case and digits.

Null texts stay null; texts without findings stay equal; repeated rows and ties are treated
alike; an empty table gives no rows. Only SQL functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.llm.common import free_name

# Name of the session setting that holds the secret key; it is kept out of the code.
KEY_SETTING = "spark.riskweave.pseudonymKey"
ROUNDS = 4  # of two half rounds each
CYCLE_START = "2000-03-01"
CYCLE_DAYS = (189, 773)

NOT_INSIDE = r"(?<![\p{L}\p{N}_])"
ENDS = r"(?![\p{L}\p{N}_])"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# Fixed formats. No pattern can run long: every repeat is bounded or possessive.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}+@"
             r"[A-Za-z0-9](?:[A-Za-z0-9-]{0,62}\.){1,8}[A-Za-z]{2,24}",
    "ip": r"(?<![\p{L}\p{N}_.])(?:" + OCTET + r"\.){3}" + OCTET + r"(?![\p{L}\p{N}_]|\.[0-9])",
    "iso_date": NOT_INSIDE + r"[0-9]{4}-[0-9]{2}-[0-9]{2}" + ENDS,
    "year_first": NOT_INSIDE + r"[0-9]{4}(?:/[0-9]{2}/|\.[0-9]{2}\.)[0-9]{2}" + ENDS,
    "date": NOT_INSIDE + r"[0-9]{2}([/.])[0-9]{2}\1[0-9]{4}" + ENDS,
    "ssn": NOT_INSIDE + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + ENDS,
    "card": NOT_INSIDE + r"[0-9](?:[ -]?[0-9]){12,18}+" + ENDS,
    "phone": r"(?<![\p{L}\p{N}_])\+[0-9](?:[ .()-]{0,2}[0-9]){6,14}+(?![\p{L}\p{N}_]|[ .-][0-9])|"
             r"(?<![\p{L}\p{N}_+])(?<![0-9][ .-])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\)[ .-]?|[0-9]{2,4}[ .-])"
             r"[0-9]{3,4}[ .-][0-9]{4}(?![\p{L}\p{N}_]|[ .-][0-9])",
}
# Layouts of cards (16, 15, 14, 13 and 19 digits) and of phone numbers.
CARD_16 = r"[0-9]{4}(?:(?: [0-9]{4}){3}|(?:-[0-9]{4}){3})"
CARDS = (r"(?:[0-9]{13,19}|[0-9]{4}(?: [0-9]{6} |-[0-9]{6}-)[0-9]{4,5}|"
         + CARD_16 + r"[ -][0-9]{3}(?![ -]?[0-9])|" + CARD_16 + r"|[0-9]{4}(?:(?: [0-9]{3}){3}|(?:-[0-9]{3}){3}))")
CARD_LAYOUTS = NOT_INSIDE + CARDS + ENDS
SHORT_CARDS = NOT_INSIDE + CARD_16 + ENDS
PHONE_TAIL = r"[0-9]{3}[ .-][0-9]{4}"
PHONES = r"(?:(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{3}\)[ .-]?|(?:\+[0-9]{1,3}[ .-])?[0-9]{3}[ .-])" + PHONE_TAIL
PHONE_LAYOUTS = r"(?<![\p{L}\p{N}_+])" + PHONES + ENDS
# With one separator throughout, no part of a longer number with that separator.
SURE_PHONES = (r"(?<![\p{L}\p{N}_+])(?<![0-9][.-])(?:\+[0-9]{1,3}[ .-]?)?(?:[0-9]{3}-[0-9]{3}-|"
               r"[0-9]{3}\.[0-9]{3}\.|\([0-9]{3}\)[ -]?[0-9]{3}-)[0-9]{4}" + ENDS + r"(?![.-][0-9])")
# Two in a row have more digits than a card.
NEXT_PHONES = (NOT_INSIDE + r"[0-9]{3}[ .-]" + PHONE_TAIL + r"(?= [0-9]{3}[ .-]" + PHONE_TAIL + ENDS
               + r")|(?<=[0-9]{3}[ .-]" + PHONE_TAIL + r" )[0-9]{3}[ .-]" + PHONE_TAIL + ENDS)


MARK = "\uffff"  # no character; texts that have it all the same are not joined again


def any_of(*patterns: str) -> str:
    return "|".join(f"(?:{p})" for p in patterns)


FIXED = [p for kind, p in PATTERNS.items() if kind not in ("card", "phone")]
# One scan each, over what the scans before left. Of these only "date" has a group.
SCANS = (any_of(*FIXED, CARD_LAYOUTS, SURE_PHONES, NEXT_PHONES), any_of(*PATTERNS.values()),
         any_of(*FIXED, SHORT_CARDS, PHONE_LAYOUTS), any_of(*FIXED, CARD_LAYOUTS))
WHOLE = {kind: f"^(?:{p})$" for kind, p in PATTERNS.items()}


def hashed(key: str, tweak: str, turn: Column, value: Column) -> Column:
    """A non-negative number of 60 bits."""
    text = F.concat_ws("|", F.lit(key), F.lit(tweak), turn.cast("string"),
                       value.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("bigint")


def permuted(x: Column, a: Column, b: Column, key: str, tweak: str,
             inverse: bool = False) -> Column:
    """Feistel permutation of 0 .. a * b - 1."""
    start = F.struct(F.call_function("div", x, b).alias("l"), (x % b).alias("r"))
    turns = F.sequence(F.lit(0), F.lit(ROUNDS - 1))

    def forth(acc, turn):
        left = F.pmod(acc["l"] + hashed(key, tweak, 2 * turn, acc["r"]) % a, a)
        right = F.pmod(acc["r"] + hashed(key, tweak, 2 * turn + 1, left) % b, b)
        return F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))

    def back(acc, turn):
        right = F.pmod(acc["r"] - hashed(key, tweak, 2 * turn + 1, acc["l"]) % b, b)
        left = F.pmod(acc["l"] - hashed(key, tweak, 2 * turn, right) % a, a)
        return F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))

    return F.aggregate(F.reverse(turns) if inverse else turns, start,
                       back if inverse else forth, lambda acc: acc["l"] * b + acc["r"])


def power_of_ten(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, F.lit("0")).cast("bigint")


def permuted_digits(digits: Column, key: str, tweak: str, inverse: bool) -> Column:
    """Digits of any length from 2 to 18, keeping leading zeros."""
    n = F.length(digits)
    half = F.floor(n / 2).cast("int")
    out = permuted(digits.cast("bigint"), power_of_ten(half), power_of_ten(n - half), key,
                   tweak, inverse)
    return F.lpad(out.cast("string"), n, F.lit("0"))


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def laid_out(value: Column, digits: Column) -> Column:
    """The value with its digits replaced in order, everything else in place."""
    start = F.struct(F.lit("").alias("text"), F.lit(1).alias("at"))

    def put(acc, c):
        is_digit = c.between("0", "9")
        return F.struct(
            F.concat(acc["text"], F.when(is_digit, F.substr(digits, acc["at"], F.lit(1)))
                     .otherwise(c)).alias("text"),
            (acc["at"] + is_digit.cast("int")).alias("at"))

    return F.aggregate(F.split(value, ""), start, put, lambda acc: acc["text"])


def card(value: Column, key: str, inverse: bool) -> Column:
    digits = digits_of(value)
    n = F.length(digits)
    payload = permuted_digits(F.substr(digits, F.lit(1), n - 1), key, "card", inverse)
    check = F.filter(F.array(*[F.lit(str(d)) for d in range(10)]),
                     lambda d: F.call_function("luhn_check", F.concat(payload, d)))[0]
    return laid_out(value, F.concat(payload, check))


def phone(value: Column, key: str, inverse: bool) -> Column:
    """The last ten digits (all, if fewer) are permuted, a country code stays."""
    digits = digits_of(value)
    kept = F.greatest(F.length(digits) - 10, F.lit(0))
    rest = F.substr(digits, kept + 1, F.lit(10))
    return laid_out(value, F.concat(F.substr(digits, F.lit(1), kept),
                                    permuted_digits(rest, key, "phone", inverse)))


def ip(value: Column, key: str, inverse: bool) -> Column:
    number = F.aggregate(F.split(value, r"\."), F.lit(0).cast("bigint"),
                         lambda acc, part: acc * 256 + part.cast("bigint"))
    half = F.lit(65536).cast("bigint")
    out = permuted(number, half, half, key, "ip", inverse)
    return F.concat_ws(".", *[F.shiftright(out, s).bitwiseAND(F.lit(255)).cast("string")
                              for s in (24, 16, 8, 0)])


def ssn(value: Column, key: str, inverse: bool) -> Column:
    """898 areas (1 to 899 without 666), 99 groups, 9,999 serial numbers."""
    part = [F.substring(value, at, n).cast("bigint") for at, n in ((1, 3), (5, 2), (8, 4))]
    area = part[0] - 1 - (part[0] > 666).cast("bigint")
    number = (area * 99 + part[1] - 1) * 9999 + part[2] - 1
    out = permuted(number, F.lit(898 * 99).cast("bigint"), F.lit(9999).cast("bigint"), key,
                   "ssn", inverse)
    upper = F.floor(out / 9999)
    area = F.floor(upper / 99)
    area = area + 1 + (area >= 665).cast("bigint")
    return F.format_string("%03d-%02d-%04d", area, upper % 99 + 1, out % 9999 + 1)


def day(date: Column, key: str, inverse: bool) -> Column:
    a, b = CYCLE_DAYS
    days = F.datediff(date, F.lit(CYCLE_START).cast("date")).cast("bigint")
    within = F.pmod(days, F.lit(a * b))
    out = permuted(within.cast("bigint"), F.lit(a).cast("bigint"), F.lit(b).cast("bigint"),
                   key, "date", inverse)
    # Every cycle has the same calendar, so year 9999 is never left behind.
    return F.date_add(F.lit(CYCLE_START).cast("date"), (days - within + out).cast("int"))


def parsed(value: Column) -> tuple[Column, Column]:
    """Date of a two-digit form, read month first (slashes only) and day first.

    With slashes the first reading counts if both are dates; a pseudonym that was read day
    first can then read month first, the one case that ``restore`` cannot tell.
    """
    return (F.try_to_date(value, "MM/dd/yyyy"),
            F.try_to_date(F.translate(value, ".", "/"), "dd/MM/yyyy"))


def shifted(text: Column, by: Column, sign: int) -> Column:
    """Every ASCII letter and digit, and the accented Latin-1 letters, moved on within its
    class by a byte of ``by`` (64 hexadecimal digits)."""
    def move(i):
        c = F.substr(text, i, F.lit(1))
        code = F.ascii(c)
        step = sign * F.conv(F.substr(by, 2 * ((i - 1) % 32) + 1, F.lit(2)), 16, 10).cast("int")
        out = c
        for low, size in ((48, 10), (65, 26), (97, 26), (0xC0, 23), (0xE0, 23)):
            out = F.when(code.between(low, low + size - 1),
                         F.char(F.pmod(code - low + step, F.lit(size)) + low)).otherwise(out)
        return out

    return F.when(F.length(text) == 0, "").otherwise(
        F.array_join(F.transform(F.sequence(F.lit(1), F.length(text)), move), ""))


def email(value: Column, key: str, inverse: bool) -> Column:
    local, host = F.split_part(value, F.lit("@"), F.lit(1)), F.split_part(
        value, F.lit("@"), F.lit(2))
    half = F.floor(F.length(local) / 2).cast("int")
    start = F.struct(F.substr(local, F.lit(1), half).alias("l"),
                     F.substr(local, half + 1, F.length(local)).alias("r"))
    turns = F.sequence(F.lit(0), F.lit(ROUNDS - 1))

    def stream(turn, other):
        return F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), turn.cast("string"), other),
                      256)

    def forth(acc, turn):
        left = shifted(acc["l"], stream(2 * turn, acc["r"]), 1)
        return F.struct(left.alias("l"),
                        shifted(acc["r"], stream(2 * turn + 1, left), 1).alias("r"))

    def back(acc, turn):
        right = shifted(acc["r"], stream(2 * turn + 1, acc["l"]), -1)
        return F.struct(shifted(acc["l"], stream(2 * turn, right), -1).alias("l"),
                        right.alias("r"))

    moved = F.aggregate(F.reverse(turns) if inverse else turns, start,
                        back if inverse else forth, lambda acc: F.concat(acc["l"], acc["r"]))
    return F.concat(moved, F.lit("@"), host)


def kind_of(value: Column) -> Column:
    """Kind of a found value, null if it is not valid."""
    digits = digits_of(value)
    area, group, serial = (F.substring(value, at, n).cast("int")
                           for at, n in ((1, 3), (5, 2), (8, 4)))
    month_first, day_first = parsed(value)
    is_kind = {kind: value.rlike(pattern) for kind, pattern in WHOLE.items()}
    return (F.when(is_kind["email"], "email")
            .when(is_kind["ip"], "ip")
            .when(is_kind["iso_date"],
                  F.when(F.try_to_date(value, "yyyy-MM-dd").isNotNull(), "iso_date"))
            .when(is_kind["year_first"], F.when(
                F.try_to_date(F.translate(value, ".", "/"), "yyyy/MM/dd").isNotNull(), "year_first"))
            .when(is_kind["date"], F.when(month_first.isNotNull(), "month_first")
                  .when(day_first.isNotNull(), "day_first"))
            .when(is_kind["ssn"], F.when((area > 0) & (area != 666) & (area < 900)
                                         & (group > 0) & (serial > 0), "ssn"))
            .when(is_kind["phone"] & F.length(digits).between(7, 15), "phone")
            .when(is_kind["card"] & F.call_function("luhn_check", digits), "card"))


def replaced(value: Column, kind: Column, key: str, inverse: bool) -> Column:
    month_first, day_first = parsed(value)
    us, eu = (F.date_format(day(d, key, inverse), f) for d, f in (
        (month_first, "MM/dd/yyyy"), (day_first, "dd/MM/yyyy")))
    return (F.when(kind == "email", email(value, key, inverse))
            .when(kind == "ip", ip(value, key, inverse))
            .when(kind == "iso_date", F.date_format(
                day(F.try_to_date(value, "yyyy-MM-dd"), key, inverse), "yyyy-MM-dd"))
            .when(kind == "year_first", F.replace(F.date_format(
                day(F.try_to_date(F.translate(value, ".", "/"), "yyyy/MM/dd"), key, inverse),
                "yyyy-MM-dd"), F.lit("-"), F.substring(value, 5, 1)))
            .when(kind == "month_first", us)
            .when(kind == "day_first", F.replace(eu, F.lit("/"), F.substring(value, 3, 1)))
            .when(kind == "ssn", ssn(value, key, inverse))
            .when(kind == "phone", phone(value, key, inverse))
            .when(kind == "card", card(value, key, inverse))
            .otherwise(value))


def scanned(part: Column, pattern: str) -> Column:
    """The part cut at the valid values of a pattern; a part with a kind stays as it is.

    What is not valid is joined again with the text around it, for the scans to come.
    """
    text = part["text"]
    found = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda v: F.struct(
        v.alias("text"), kind_of(v).alias("kind")))

    def gap(value: Column) -> Column:
        return F.struct(value.alias("text"), F.lit(None).cast("string").alias("kind"))

    def cut(values: Column) -> Column:
        marked = F.transform(values, lambda p: F.when(p["kind"].isNull(), p["text"]).otherwise(MARK))
        rest = F.array_join(F.zip_with(F.split(text, pattern), F.concat(marked, F.array(F.lit(""))),
                                       lambda g, value: F.concat(g, value)), "")
        joined = F.zip_with(F.transform(F.split(rest, MARK), gap), F.filter(
            values, lambda p: p["kind"].isNotNull()), lambda g, value: F.array(g, value))
        loose = F.zip_with(F.transform(F.split(text, pattern), gap), values,
                           lambda g, value: F.array(g, value))
        return F.flatten(F.when(F.contains(text, F.lit(MARK)), loose).otherwise(joined))

    # An array of one, so that what is found is computed once.
    parts = F.flatten(F.transform(F.array(found), lambda values: cut(values)))
    return F.when(part["kind"].isNotNull(), F.array(part)).otherwise(
        F.filter(parts, lambda p: F.length(p["text"]) > 0))


def session_key(spark: SparkSession, default: str | None = None) -> str:
    """The key that the session names; without one and without a default there is none."""
    key = spark.conf.get(KEY_SETTING, None) or default
    if not key:
        raise ValueError(f"set {KEY_SETTING} to the secret key of the pseudonyms")
    return key


def pseudonymise(docs: DataFrame, key: str, inverse: bool = False,
                 kinds: str | None = None) -> DataFrame:
    """All columns, ``text`` with pseudonyms. ``kinds`` names a new column for the array of
    the kinds that were replaced. Who has the key can restore the values."""
    text = F.col("text")
    parts, names = (free_name(docs, n) for n in ("parts", "kinds"))
    able = F.lit(False)
    for pattern in SCANS:
        able = able | text.rlike(pattern)
    whole = F.array(F.struct(text.alias("text"), F.lit(None).cast("string").alias("kind")))
    cut = whole
    for pattern in SCANS:
        cut = F.flatten(F.transform(cut, lambda p: scanned(p, pattern)))
    out = docs.withColumn(parts, F.when(text.rlike("[0-9@]") & able, cut).otherwise(
        F.array().cast("array<struct<text:string,kind:string>>")))
    joined = F.array_join(F.transform(parts, lambda p: F.when(
        p["kind"].isNotNull(), replaced(p["text"], p["kind"], key, inverse)).otherwise(p["text"])), "")
    out = out.withColumn(names, F.filter(F.transform(parts, lambda p: p["kind"]),
                                         lambda k: k.isNotNull()))
    out = out.withColumn("text", F.when(F.size(names) > 0, joined).otherwise(text)).drop(parts)
    return out.withColumnRenamed(names, kinds) if kinds else out.drop(names)


def restore(docs: DataFrame, key: str) -> DataFrame:
    return pseudonymise(docs, key, inverse=True)
