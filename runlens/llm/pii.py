"""Personal data replaced by keyed pseudonyms of the same format.

Numbers and dates are validated (Luhn, mod 97, octets, calendar) and permuted by a keyed Feistel network
within their format: the result has the same length and separators, passes the same check, and equal values stay equal in
all documents, so they remain linked. Different values of a format stay different.

* digit strings: two halves of digits, each round adds a keyed digest of one half to the other, modulo a power of ten;
* cards and account numbers: all digits but the last are permuted, and the last keeps its distance from the Luhn digit; with `luhn`
  only numbers whose last digit is the Luhn digit count, others (order numbers, ISBNs, time stamps) stay as they are. A run of
  digit groups is searched for them, so that a card is also found beside other numbers;
* IBANs, in one piece or printed in groups of four: the digits of the account part are permuted, letters stay, check digits are computed
  anew. Printed ones are known by the length that their country gives them;
* phones: the country code stays, the digits behind it are permuted, however they are grouped;
* IPv4 addresses: two halves of 16 bits;
* dates (`yyyy-MM-dd`, `dd.MM.yyyy`, `dd/MM/yyyy`, `MM/dd/yyyy`, two digits each): the day within its 400-year calendar cycle
  (146097 = 189 * 773 days), so that a day is linked whatever its form. With slashes the part above 12 is the day; where both may be
  months, the month is first, or the day with `day_first`. What day-first and month-first forms become may look alike;
* e-mail addresses, which have no fixed format, get a keyed digest as local part (`email_digits` hex digits) and a reserved domain.

Only built-in expressions; each row is handled on its own. A null text stays null; repeated rows give equal rows; only the
id and the text column are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
CYCLE_DAYS, DAYS_LEFT, DAYS_RIGHT = 146097, 189, 773
FIRST_DAY = "1000-01-01"

_ISO = r"[1-9][0-9]{3}-(?:0[1-9]|1[0-2])-(?:0[1-9]|[12][0-9]|3[01])(?![0-9-])"
_DD, _MM, _YYYY = "(?:0[1-9]|[12][0-9]|3[01])", "(?:0[1-9]|1[0-2])", "[1-9][0-9]{3}"
_DOTTED = rf"{_DD}\.{_MM}\.{_YYYY}(?![0-9]|\.[0-9])"
_SLASHED = rf"(?:{_DD}/{_MM}|{_MM}/{_DD})/{_YYYY}(?![0-9/])"
_DAY = f"(?:{_ISO}|{_DOTTED}|{_SLASHED})"
_SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
_LOCAL = r"[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])"

# fixed values: length of an IBAN by country
IBAN_LENGTHS: dict[int, str] = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "GI IL IQ TL", 24: "AD AE CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR",
    27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC"}


def _printed_iban() -> str:
    """Groups of four behind country and check digits, the last one shorter where the length asks for it."""
    forms = []
    for length, countries in IBAN_LENGTHS.items():
        groups, rest = divmod(length - 4, 4)
        tail = rf"[ -][A-Z0-9]{{{rest}}}" if rest else ""
        forms.append(rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?:[ -][A-Z0-9]{{4}}){{{groups}}}{tail}(?![A-Za-z0-9])")
    return r"(?<![A-Za-z0-9])(?=[A-Z]{2}[0-9]{2}[ -])(?:" + "|".join(forms) + ")"


# fixed values: country codes of telephone numbers; those that are not listed have three digits
CALLING_CODE = r"\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"

# fixed values: formats, in the order in which they are tried at a place
FORMATS: tuple[tuple[str, str], ...] = (
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9](?:[A-Za-z0-9-]*+\.)+[A-Za-z]{2,24}+(?![A-Za-z0-9])"),
    ("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}+(?![A-Za-z0-9])"),
    ("iban", _printed_iban()),
    ("ip", r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![0-9]|\.[0-9])"),
    ("date", r"(?<![0-9-])" + _ISO), ("date", r"(?<![0-9.])" + _DOTTED), ("date", r"(?<![0-9/])" + _SLASHED),
    ("phone", r"(?<![0-9])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"),
    ("ssn", r"(?<![0-9-])" + _SSN),
    # a run of digit groups, up to a group that starts another format
    ("card", r"(?<![0-9A-Za-z])(?=[0-9](?:[ -]?[0-9]){12})[0-9]{1,19}+(?![0-9A-Za-z])"
     rf"(?:(?! (?:{_DAY}|{_SSN}|{_LOCAL}))[ -][0-9]{{1,19}}+(?![0-9A-Za-z]))*+"),
    ("phone", r"(?<![0-9])\+[0-9]{8,15}(?![0-9])"),
    # any grouping behind a country code, as many groups as 15 digits allow
    ("phone", r"(?<![0-9])\+[0-9](?:[ .-]?\(?[0-9]\)?){7,14}(?![0-9])"),
)
# digits in the groups of a printed card
PRINTED = "^(?:4 4 4 [1-4]|4 4 4 4 [1-3]|4 6 [45]|6 13)$"
ANY = "|".join(p for _, p in FORMATS)
HINT = "[0-9@]"


def _whole(kind: str) -> str:
    return "^(?:" + "|".join(p for k, p in FORMATS if k == kind) + ")$"


def _drawn(key: str, label: str, length: Column, round_: Column, half: Column) -> Column:
    """A keyed number below 2**60 for one half in one round."""
    text = F.concat_ws("|", F.lit(key), F.lit(label), length.cast("string"), round_.cast("string"), half.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("bigint")


def feistel(left: Column, right: Column, mod_left: Column, mod_right: Column, key: str, label: str, length: Column) -> Column:
    """struct(l, r): a keyed permutation of the pairs with l < mod_left, r < mod_right."""
    first = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))

    def one(pair: Column, i: Column) -> Column:
        turned_l = F.pmod(pair["l"] + F.pmod(_drawn(key, label, length, i, pair["r"]), mod_left), mod_left)
        turned_r = F.pmod(pair["r"] + F.pmod(_drawn(key, label, length, i, pair["l"]), mod_right), mod_right)
        even = i % 2 == 0
        return F.struct(F.when(even, turned_l).otherwise(pair["l"]).cast("bigint").alias("l"),
                        F.when(even, pair["r"]).otherwise(turned_r).cast("bigint").alias("r"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), first, one)


def permuted_digits(digits: Column, key: str, label: str) -> Column:
    """A digit string of 2 to 34 digits, permuted among the strings of its length."""
    n = F.char_length(digits)
    u = F.floor(n / 2).cast("int")
    ten = lambda k: F.pow(F.lit(10.0), k).cast("bigint")  # noqa: E731  exact up to 10**17
    parts = feistel(digits.substr(F.lit(1), u), digits.substr(u + 1, n - u), ten(u), ten(n - u), key, label, n)
    # evaluated once: the struct goes through a one-element array
    return F.element_at(F.transform(F.array(parts), lambda p: F.concat(
        F.lpad(p["l"].cast("string"), u, F.lit("0")), F.lpad(p["r"].cast("string"), n - u, F.lit("0")))), 1)


def _refilled(shape: Column, digits: Column) -> Column:
    """`shape` with its digits replaced, in order, by those of `digits`."""
    start = F.struct(F.lit("").alias("s"), F.lit(1).alias("i"))

    def put(acc: Column, c: Column) -> Column:
        is_digit = c.between("0", "9")
        return F.struct(F.concat(acc["s"], F.when(is_digit, digits.substr(acc["i"], F.lit(1))).otherwise(c)).alias("s"),
                        F.when(is_digit, acc["i"] + 1).otherwise(acc["i"]).alias("i"))

    return F.aggregate(F.filter(F.split(shape, ""), lambda c: c != ""), start, put, lambda acc: acc["s"])


def luhn_digit(digits: Column) -> Column:
    """The check digit that belongs after these digits."""
    n = F.char_length(digits)

    def weighed(c: Column, i: Column) -> Column:
        d = c.cast("int") * F.when((n - i) % 2 == 1, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    total = F.aggregate(F.transform(F.filter(F.split(digits, ""), lambda c: c != ""), weighed), F.lit(0), lambda a, b: a + b)
    return F.pmod(-total, F.lit(10))


def mod97(account: Column) -> Column:
    """Remainder of a string of digits and capitals (A = 10 … Z = 35)."""
    def more(acc: Column, c: Column) -> Column:
        return F.when(c.between("0", "9"), acc * 10 + c.cast("int")).otherwise(acc * 100 + F.ascii(c) - 55) % 97

    return F.aggregate(F.filter(F.split(account, ""), lambda c: c != ""), F.lit(0), lambda a, c: more(a, c).cast("int"))


def _only_digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _once(value: Column, fn) -> Column:
    """fn(value) with `value` evaluated once."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def card_pieces(run: Column, luhn: bool) -> Column:
    """A run of digit groups as an array of struct(t, card): from the left, the longest numbers of 13 to 19 digits, and what lies between.
    With `luhn` a number ends in its Luhn digit and is one group, the whole run, or printed as cards are, with one separator."""
    def piece(text: Column, card: bool) -> Column:
        return F.struct(text.alias("t"), F.lit(card).alias("card"))

    def search(parts: Column) -> Column:
        groups, seps = parts["g"], parts["s"]  # seps[i + 1] follows group i, both from 1
        n = F.size(groups)
        text = lambda a, b: F.array_join(F.zip_with(F.slice(groups, a, b - a + 1), F.slice(seps, a + 1, b - a + 1), lambda g, z: F.concat(g, z)), "")

        def fits(i: Column, j: Column) -> Column:
            digits = F.array_join(F.slice(groups, i, j - i + 1), "")
            size = F.char_length(digits)
            right = size.between(13, 19)
            if not luhn:
                return right
            lengths = F.array_join(F.transform(F.slice(groups, i, j - i + 1), lambda g: F.char_length(g).cast("string")), " ")
            printed = (F.size(F.array_distinct(F.slice(seps, i + 1, j - i))) == 1) & lengths.rlike(PRINTED)
            return right & ((i == j) | ((i == 1) & (j == n)) | printed) & (
                luhn_digit(digits.substr(F.lit(1), size - 1)) == digits.substr(size, F.lit(1)).cast("int"))

        def step(acc: Column, i: Column) -> Column:
            last = F.array_max(F.filter(F.sequence(i, F.least(i + 18, n)), lambda j: fits(i, j)))
            found = lambda j: F.struct(F.concat(acc["out"], F.array(
                piece(text(acc["at"], i - 1), False), piece(F.concat(text(i, j - 1), F.element_at(groups, j)), True),
                piece(F.element_at(seps, j + 1), False))).alias("out"), (j + 1).alias("at"))
            return F.when(i < acc["at"], acc).otherwise(_once(last, lambda j: F.when(j.isNull(), acc).otherwise(found(j))))

        start = F.struct(F.array().cast("array<struct<t:string,card:boolean>>").alias("out"), F.lit(1).alias("at"))
        return F.aggregate(F.sequence(F.lit(1), n), start, step,
                           lambda acc: F.concat(acc["out"], F.array(piece(text(acc["at"], n), False))))

    return _once(F.struct(F.regexp_extract_all(run, F.lit("[0-9]+"), F.lit(0)).alias("g"), F.split(run, "[0-9]+", -1).alias("s")), search)


def _number(value: Column, key: str) -> Column:
    def made(d: Column) -> Column:
        body = d.substr(F.lit(1), F.char_length(d) - 1)
        distance = d.substr(F.char_length(d), F.lit(1)).cast("int") - luhn_digit(body)
        return _once(permuted_digits(body, key, "number"),
                     lambda new: _refilled(value, F.concat(new, F.pmod(luhn_digit(new) + distance, F.lit(10)).cast("string"))))

    return _once(_only_digits(value), made)


def _compact(iban: Column) -> Column:
    return F.translate(iban, " -", "")


def _iban(value: Column, key: str) -> Column:
    plain = _compact(value)
    country, account = plain.substr(F.lit(1), F.lit(2)), plain.substr(F.lit(5), F.char_length(plain))

    def made(digits: Column) -> Column:
        new = F.when(F.char_length(digits) >= 2, permuted_digits(digits, key, "iban")).otherwise(digits)
        return _once(_once(new, lambda d: _refilled(account, d)), lambda a: _refilled(value, F.concat(
            F.lpad((98 - mod97(F.concat(a, country, F.lit("00")))).cast("string"), 2, "0"), _only_digits(a))))

    return _once(_only_digits(account), made)


def _ip(value: Column, key: str) -> Column:
    o = [F.element_at(F.split(value, r"\."), i).cast("bigint") for i in (1, 2, 3, 4)]
    half = F.lit(65536).cast("bigint")
    return _once(feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], half, half, key, "ip", F.lit(4)), lambda p: F.concat_ws(
        ".", *[x.cast("string") for x in (F.shiftright(p["l"], 8), p["l"] % 256, F.shiftright(p["r"], 8), p["r"] % 256)]))


def date_form(value: Column, day_first: bool) -> Column:
    """The pattern that a date is written in; with slashes the first of two readings that is a day."""
    forms = ["dd/MM/yyyy", "MM/dd/yyyy"] if day_first else ["MM/dd/yyyy", "dd/MM/yyyy"]
    slashed = F.when(F.try_to_timestamp(value, F.lit(forms[0])).isNotNull(), forms[0]).otherwise(forms[1])
    return F.when(value.contains("."), "dd.MM.yyyy").when(value.contains("/"), slashed).otherwise("yyyy-MM-dd")


def _date(value: Column, key: str, day_first: bool) -> Column:
    def made(d: Column) -> Column:
        within = F.pmod(d, F.lit(CYCLE_DAYS))
        pair = feistel(F.floor(within / DAYS_RIGHT), within % DAYS_RIGHT, F.lit(DAYS_LEFT).cast("bigint"),
                       F.lit(DAYS_RIGHT).cast("bigint"), key, "date", F.lit(CYCLE_DAYS))
        return _once(pair, lambda p: F.date_add(F.lit(FIRST_DAY).cast("date"), (d - within + p["l"] * DAYS_RIGHT + p["r"]).cast("int")))

    def written_as(form: Column) -> Column:
        day = F.datediff(F.try_to_timestamp(value, form).cast("date"), F.lit(FIRST_DAY).cast("date"))
        return F.call_function("date_format", _once(day, made), form)

    return _once(date_form(value, day_first), written_as)


def _phone(value: Column, key: str) -> Column:
    """The country code stays, as it is set apart or as the list of codes has it; all other digits are permuted."""
    apart = F.regexp_extract(value, r"^(\+[0-9]{1,3})[ .(-]", 1)
    code = F.when(apart != "", apart).otherwise(F.regexp_extract(value, f"^({CALLING_CODE})", 1))
    return _once(code, lambda c: F.concat(c, _once(value.substr(F.char_length(c) + 1, F.char_length(value)), lambda rest: _refilled(
        rest, permuted_digits(_only_digits(rest), key, "phone")))))


def is_iban(value: Column) -> Column:
    return _once(_compact(value), lambda v: mod97(F.concat(v.substr(F.lit(5), F.char_length(v)), v.substr(F.lit(1), F.lit(4)))) == 1)


def shaped(value: Column) -> Column:
    """Kind of a match of `ANY` by its form alone."""
    return F.when(value.contains("@"), "email").when(value.rlike(_whole("iban")), "iban").when(value.rlike(_whole("ip")), "ip").when(
        value.rlike(_whole("date")), "date").when(value.rlike(_whole("phone")), "phone").when(value.rlike(_whole("ssn")), "ssn").otherwise("card")


def classified(value: Column, form: Column, pieces: Column, day_first: bool) -> Column:
    """Kind of a match, or null where its check fails (an IBAN's remainder, a day that no month has, a run without a card)."""
    as_day = F.try_to_timestamp(value, date_form(value, day_first))
    return (F.when(form == "iban", F.when(is_iban(value), form))
            .when(form == "date", F.when(F.year(as_day) < 9800, form))
            .when(form == "card", F.when(F.exists(pieces, lambda p: p["card"]), form))
            .otherwise(form))


KINDS = ("email", "iban", "ip", "date", "phone", "ssn", "card")


def pseudonym(value: Column, kind: Column, pieces: Column, key: str, day_first: bool, email_digits: int) -> Column:
    digest = F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(value)), 256), 1, email_digits)
    return (F.when(kind == "email", F.concat(F.lit("user-"), digest, F.lit("@example.invalid")))
            .when(kind == "iban", _iban(value, key)).when(kind == "ip", _ip(value, key)).when(kind == "date", _date(value, key, day_first))
            .when(kind == "phone", _phone(value, key))
            .when(kind == "ssn", _refilled(value, permuted_digits(_only_digits(value), key, "ssn")))
            .when(kind == "card", F.array_join(F.transform(pieces, lambda p: F.when(
                p["card"], _number(p["t"], key)).otherwise(p["t"])), "")).otherwise(value))


def pseudonymised(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text", luhn: bool = False,
                  day_first: bool = False, email_digits: int = 12) -> DataFrame:
    """One row per input row: id, text with pseudonyms in place, n_{kind} for each kind, n_pii. With `luhn` a card or account number
    counts only if its Luhn digit is right; without, each number of 13 to 19 digits does."""
    rows = docs.select(F.col(f"`{id_col}`").alias("_id"), F.col(f"`{text_col}`").alias("_text"))
    none = F.array().cast("array<string>")
    found = rows.withColumn("_found", F.when(F.col("_text").rlike(HINT), F.regexp_extract_all("_text", F.lit(ANY), F.lit(0))).otherwise(none))
    forms = found.withColumn("_forms", F.transform("_found", lambda v: _once(shaped(v), lambda f: F.struct(
        v.alias("v"), f.alias("f"), F.when(f == "card", card_pieces(v, luhn)).alias("p")))))
    kinds = forms.withColumn("_kinds", F.transform("_forms", lambda x: classified(x["v"], x["f"], x["p"], day_first)))
    new = kinds.withColumn("_new", F.zip_with("_forms", "_kinds", lambda x, k: pseudonym(x["v"], k, x["p"], key, day_first, email_digits)))
    # split keeps what lies between the same matches, one piece more than there are matches
    whole = F.array_join(F.flatten(F.zip_with(F.split("_text", ANY, -1), F.col("_new"), lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "")
    out = new.withColumn("_out", F.when(F.size("_found") > 0, whole).otherwise(F.col("_text")))
    # a match is one value, but a run of digit groups can hold several cards
    each = F.zip_with("_forms", "_kinds", lambda x, k: F.struct(k.alias("k"), F.when(
        k == "card", F.size(F.filter(x["p"], lambda p: p["card"]))).otherwise(1).alias("n")))
    sized = out.withColumn("_each", each)

    def total(*kinds: str) -> Column:
        return F.aggregate(F.filter("_each", lambda x: x["k"].isin(*kinds)), F.lit(0).cast("long"), lambda a, x: a + x["n"])

    counts = [total(kind).alias(f"n_{kind}") for kind in KINDS]
    return sized.select(F.col("_id").alias(id_col), F.col("_out").alias(text_col), *counts, total(*KINDS).alias("n_pii"))
