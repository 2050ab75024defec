"""Personal data replaced by format-preserving pseudonyms, in native functions.

Addresses, phone and account numbers, cards and dates are found, validated (check digits, octets,
calendar) and permuted by a keyed Feistel network inside their own format: digits stay digits,
letters letters, separators where they were (and out of the permutation); check digits are made anew, dates stay dates of 1900
to 2099, network addresses stay addresses.  A permutation is one to one, so equal values get equal
pseudonyms in all documents and different ones stay different.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.matching import bound, found, gaps
from ledgerloom.llm.store import free_name

KEY = "ledgerloom"
ROUNDS = 8
# fixed values: the forms that are looked for, most specific first
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
IPV4 = r"(?<![0-9A-Za-z.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9A-Za-z]|\.[0-9])"
DATE = r"(?<![0-9A-Za-z-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9A-Za-z-])|(?<![0-9A-Za-z./])[0-9]{2}(?:\.[0-9]{2}\.|/[0-9]{2}/)[0-9]{4}(?![0-9A-Za-z]|[./][0-9])"
SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
CARD = r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}(?:(?:-[0-9]{4}){2}-|(?: [0-9]{4}){2} )[0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9A-Za-z])"
PHONE = r"\+[0-9](?:[ .()-]{0,2}[0-9]){7,14}(?![0-9A-Za-z])|(?<![0-9A-Za-z])\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9A-Za-z])|(?<![0-9A-Za-z.-])[0-9]{3}(?:-[0-9]{3}-|\.[0-9]{3}\.)[0-9]{4}(?![0-9A-Za-z.-])"
AFTER_IBAN = "|".join((IPV4, DATE, SSN, CARD, PHONE))
ANY = "|".join((EMAIL, IBAN, AFTER_IBAN))
#: characters of an account number in each country
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH CR HR LI LV", 22: "BG BH DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
NATIONAL = "^(?:" + "|".join(f"(?:{codes.replace(' ', '|')})(?: ?[A-Z0-9]){{{n - 2}}}" for n, codes in IBAN_LENGTHS.items()) + ")$"
# what a match of ANY looks like, and the span of days that dates are permuted in
KINDS = {
    "email": r"^[^@]+@[^@]+$", "iban": r"^[A-Z]{2}[0-9]{2}[A-Z0-9 ]+$", "ip": r"^[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}$",
    "date": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$|^[0-9]{2}\.[0-9]{2}\.[0-9]{4}$|^[0-9]{2}/[0-9]{2}/[0-9]{4}$", "ssn": r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$",
    "card": r"^(?:[0-9]{13,19}|[0-9]{4}[ -][0-9]{4}.*|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})$", "phone": r"^[+(0-9]",
}
FIRST_DAY, DAYS, DAY_ROWS = "1900-01-01", 73049, 271


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _mixed(key: str, what: str, *parts: Column) -> Column:
    return F.xxhash64(F.lit(f"{key}/{what}"), *parts)


def permuted(s: Column, key: str, what: str) -> Column:
    """Feistel over the characters of a string: in each round one half's letters and digits are turned
    inside their class by a keyed hash of the other half."""
    half = (F.length(s) / 2).cast("int")

    def turned(part: Column, other: Column, i: Column) -> Column:
        def one(c: Column, j: Column) -> Column:
            by, code = _mixed(key, what, i, other, j), F.ascii(c)
            in_class = lambda base, n: F.char((F.pmod(code - base + F.pmod(by, F.lit(n)), F.lit(n)) + base).cast("long"))
            return F.when(code.between(48, 57), in_class(48, 10)).when(code.between(97, 122), in_class(97, 26)).when(code.between(65, 90), in_class(65, 26)).otherwise(c)

        chars = F.filter(F.split(part, ""), lambda c: c != "")
        return F.array_join(F.transform(chars, one), "")

    start = F.struct(F.substring(s, F.lit(1), half).alias("l"), F.substring(s, half + 1, F.length(s)).alias("r"))
    step = lambda acc, i: F.struct(acc["r"].alias("l"), turned(acc["l"], acc["r"], i).alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda acc: F.concat(acc["l"], acc["r"]))


def refilled(form: Column, plain: Column) -> Column:
    """``form`` with its letters and digits replaced, in order, by those of ``plain``."""
    step = lambda acc, c: F.when(c.rlike("[A-Za-z0-9]"), F.struct(F.concat(acc["out"], F.substring(plain, acc["k"], F.lit(1))).alias("out"), (acc["k"] + 1).alias("k"))).otherwise(F.struct(F.concat(acc["out"], c).alias("out"), acc["k"].alias("k")))
    chars = F.filter(F.split(form, ""), lambda c: c != "")
    return F.aggregate(chars, F.struct(F.lit("").alias("out"), F.lit(1).alias("k")), step, lambda acc: acc["out"])


def permuted_number(x: Column, high: int, low: int, key: str, what: str) -> Column:
    """Feistel over the numbers below ``high * low``, as (x div low, x mod low)."""
    start = F.struct(F.floor(x / low).cast("long").alias("a"), F.pmod(x, F.lit(low)).cast("long").alias("b"))

    def step(acc: Column, i: Column) -> Column:
        a = F.pmod(acc["a"] + F.pmod(_mixed(key, what, i, acc["b"]), F.lit(high)), F.lit(high))
        b = F.pmod(acc["b"] + F.pmod(_mixed(key, what, -i, a), F.lit(low)), F.lit(low))
        return F.struct(a.alias("a"), b.alias("b"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS // 2)), start, step, lambda acc: acc["a"] * low + acc["b"])


def luhn_sum(digits: Column, doubled_last: bool) -> Column:
    """Luhn sum; ``doubled_last``: the last digit is doubled (the check digit is missing)."""
    chars = F.reverse(F.filter(F.split(digits, ""), lambda c: c != ""))

    def part(c: Column, i: Column) -> Column:
        d = c.cast("int")
        two = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when(i % 2 == (0 if doubled_last else 1), two).otherwise(d)

    return F.aggregate(F.transform(chars, part), F.lit(0), lambda acc, x: acc + x)


def _mod97(text: Column) -> Column:
    """Value modulo 97 of a string of digits and capital letters (A is 10)."""
    step = lambda acc, c: F.when(F.ascii(c) > 57, F.pmod(acc * 100 + F.ascii(c) - 55, F.lit(97))).otherwise(F.pmod(acc * 10 + F.ascii(c) - 48, F.lit(97)))
    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0), step)


def _card(s: Column, key: str) -> Column:
    plain = _digits(s)
    body = permuted(F.substring(plain, F.lit(1), F.length(plain) - 1), key, "card")
    check = F.pmod(10 - F.pmod(luhn_sum(body, True), F.lit(10)), F.lit(10))
    return F.when(luhn_sum(plain, False) % 10 == 0, refilled(s, F.concat(body, check.cast("string")))).otherwise(s)


def _valid_iban(s: Column) -> Column:
    plain = F.regexp_replace(s, " ", "")
    return F.length(plain).between(15, 34) & (_mod97(F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, 1, 4))) == 1)


def _accounts(text: Column) -> Column:
    """For each place where an account number may begin, the valid one; null if there is none.

    The form takes in words that follow, so all cuts at a space are tried: first the country's length, then the longest.
    """

    def one(c: Column) -> Column:
        words = F.split(c, " ")
        cuts = F.filter(F.transform(F.sequence(F.size(words), F.lit(1), F.lit(-1)), lambda k: F.array_join(F.slice(words, 1, k), " ")), _valid_iban)
        return F.coalesce(F.get(F.filter(cuts, lambda x: x.rlike(NATIONAL)), F.lit(0)), F.get(cuts, F.lit(0)))

    places = F.regexp_extract_all(text, F.lit(f"(?<![A-Za-z0-9])(?=({IBAN}))"), F.lit(1))
    return F.when(text.rlike(IBAN), F.transform(places, one)).otherwise(F.array().cast("array<string>"))


def _forms(accounts: Column) -> Column:
    """The pattern for one text: ANY with its valid account numbers, the longest first, in place of their form,
    so what only looks like one doesn't hide the other forms in it."""
    valid = F.array_sort(F.array_distinct(F.filter(accounts, lambda x: x.isNotNull())), lambda a, b: F.length(b) - F.length(a))
    known = F.concat(F.lit(f"{EMAIL}|(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}})(?:"), F.array_join(valid, "|"), F.lit(f")(?![A-Za-z0-9])|{AFTER_IBAN}"))
    return F.when(F.size(valid) > 0, known).otherwise(F.lit(f"{EMAIL}|{AFTER_IBAN}"))


def _iban(s: Column, key: str) -> Column:
    plain = F.regexp_replace(s, " ", "")
    country, account = F.substring(plain, 1, 2), F.substring(plain, F.lit(5), F.length(plain))
    body = permuted(account, key, "iban")
    check = 98 - _mod97(F.concat(body, country, F.lit("00")))
    return F.when(_valid_iban(s), refilled(s, F.concat(country, F.lpad(check.cast("string"), 2, "0"), body))).otherwise(s)


def _ip(s: Column, key: str) -> Column:
    octets = F.transform(F.split(s, "\\."), lambda x: x.cast("long"))
    x = F.aggregate(octets, F.lit(0).cast("long"), lambda acc, o: acc * 256 + o)
    y = permuted_number(x, 65536, 65536, key, "ip")
    out = F.concat_ws(".", *[F.pmod(F.shiftright(y, n), F.lit(256)).cast("string") for n in (24, 16, 8, 0)])
    return F.when(F.forall(octets, lambda o: o < 256), out).otherwise(s)


def _date(s: Column, key: str) -> Column:
    """Days are permuted again until they fall in the span: each day is met once, so it stays one to one."""
    out = s
    for form, shape in (("MM/dd/yyyy", r"^\d{2}/\d{2}/\d{4}$"), ("dd/MM/yyyy", r"^\d{2}/\d{2}/\d{4}$"), ("dd.MM.yyyy", r"^\d{2}\.\d{2}\.\d{4}$"), ("yyyy-MM-dd", r"^\d{4}-\d{2}-\d{2}$")):
        day = F.date_diff(F.try_to_date(s, form), F.lit(FIRST_DAY).cast("date")).cast("long")
        again = lambda acc, i: F.when((i > 0) & (acc < DAYS), acc).otherwise(permuted_number(acc, DAY_ROWS, DAY_ROWS, key, "date"))
        moved = F.aggregate(F.sequence(F.lit(0), F.lit(200)), day, again)
        new = F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), moved.cast("int")), form)
        first = F.when(F.substring(s, 1, 2).cast("int") > 12, form != "MM/dd/yyyy").otherwise(form != "dd/MM/yyyy") if "/" in form else F.lit(True)
        out = F.when(s.rlike(shape) & first, F.when(day.between(0, DAYS - 1), new).otherwise(s)).otherwise(out)
    return out


def _phone(s: Column, key: str) -> Column:
    """The country code and, in it, the first digit after a plus stay."""
    code = F.regexp_extract(s, r"^\+[0-9]{1,3}(?=[ .(-])|^\+[0-9]", 0)
    rest = F.substring(s, F.length(code) + 1, F.length(s))
    return F.concat(code, refilled(rest, permuted(_digits(rest), key, "phone")))


def _email(s: Column, key: str) -> Column:
    """Local part and the domain but for its last label."""
    name, host, top = F.substring_index(s, "@", 1), F.regexp_extract(s, r"@(.*)\.[^.]*$", 1), F.substring_index(s, ".", -1)
    return F.concat(permuted(name, key, "email"), F.lit("@"), permuted(host, key, "host"), F.lit("."), top)


def _ssn(s: Column, key: str) -> Column:
    return F.when(s.rlike(r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$"), permuted(s, key, "ssn")).otherwise(s)


def pseudonym(match: Column, key: str) -> Column:
    """The pseudonym of one match; itself if it isn't valid."""
    makers = {"email": _email, "iban": _iban, "ip": _ip, "date": _date, "ssn": _ssn, "card": _card, "phone": _phone}
    out = match
    for kind in reversed(list(KINDS)):
        out = F.when(match.rlike(KINDS[kind]), makers[kind](match, key)).otherwise(out)
    return out


def replaced(text: Column, key: str = KEY) -> Column:
    def whole(forms: Column) -> Column:
        new = F.transform(found(text, forms), lambda m: pseudonym(m, key))
        return F.array_join(F.zip_with(gaps(text, forms), new, lambda g, m: F.concat(g, F.coalesce(m, F.lit("")))), "")

    return F.when(_any(text), bound(bound(_accounts(text), _forms), whole)).otherwise(text)


def _any(text: Column) -> Column:
    """Is there a match?  Most texts have neither digit nor at sign and are told by the short pattern."""
    return text.rlike("[0-9@]") & text.rlike(ANY)


def pseudonymise(docs: DataFrame, key: str = KEY) -> DataFrame:
    """The rows of ``docs`` with pseudonyms in ``text``; ``n_chars``, if there is one, follows a changed text.

    Null and empty texts stay; values that fail their check stay; repeated rows change alike; other
    columns pass through; an empty table gives no rows.
    """
    name = free_name(docs, "__text")
    new = docs.withColumn(name, replaced(F.col("text"), key))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new = new.withColumn("n_chars", F.when(F.col(name) != F.col("text"), F.length(name).cast(kind)).otherwise(F.col("n_chars")))
    return new.withColumn("text", F.col(name)).select(*docs.columns)


def report(docs: DataFrame, key: str = KEY) -> DataFrame:
    """doc_id, the text with pseudonyms, and n_found (values looked at, valid or not)."""
    text = F.col("text")
    looked_at = bound(_accounts(text), lambda a: F.size(found(text, _forms(a))) + F.size(F.filter(a, lambda x: x.isNull())))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), replaced(text, key).alias("text"),
        F.when(_any(text), looked_at).otherwise(0).cast("long").alias("n_found"),
    )
