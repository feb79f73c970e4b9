"""Format-preserving Feistel pseudonyms for personal data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
DEFAULT_KEY = "change-me"  # callers pass their own secret; equal keys give equal pseudonyms

# Date domain: 271 * 270 days from this one on (1900-01-01 to 2100-05-02), a product so that both halves are whole.
FIRST_DAY, DAYS_A, DAYS_B = "1900-01-01", 271, 270
# Valid social security numbers: 898 areas (1 to 899 without 666) * 99 groups, and 9999 serials.
SSN_A, SSN_B = 898 * 99, 9999

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
# Fixed formats; the order is the order of the alternatives. All but e-mails begin where no word character precedes.
# A name has 127 labels at most; what a longer one goes on with stays, as the labels of all e-mails do.
FORMATS = {
    "email": r"(?<![\p{L}\p{N}._+-])[\p{L}\p{N}._+-]{1,64}+@[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9-]*[A-Za-z0-9]){1,127}",
    "iban": r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?!\w)",
    "phone": r"(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?!\w)"
             r"|\+[0-9]{1,3}[ .-]?[0-9]{3}[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?!\w)"
             r"|(?<![.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![\w-]|\.[0-9])",
    "ssn": r"(?<!-)(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![\w-])",
    "date": r"(?<!-)(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2}(?![0-9-])|(?<!/)[0-9]{2}/[0-9]{2}/(?:19|20)[0-9]{2}(?![\w/])",
    "ip": rf"(?<!\.){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.[0-9])",
    "card": r"(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?!\w)",
    "secret": r"(?=[A-Fa-f]*[0-9])[0-9A-Fa-f]{32,}+(?!\w)",
}
# What begins a value is tested before the alternatives are, so that most places of a text fail at once.
ANY = FORMATS["email"] + r"|(?=[0-9A-Za-f+(])(?<!\w)(?:" + "|".join(p for k, p in FORMATS.items() if k != "email") + ")"


def _let(value: Column, f) -> Column:
    """``f(value)`` with ``value`` worked out once, however often ``f`` uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def _is(kind: str, value: Column) -> Column:
    return value.rlike(f"^(?:{FORMATS[kind]})$")


def _prf(key: str, kind: str, turn: Column, other: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), turn.cast("string"), other), 512)


def _hex(digest: Column, start: Column | int, n: int) -> Column:
    start = F.lit(start) if isinstance(start, int) else start
    return F.conv(F.substr(digest, start, F.lit(n)), 16, 10).cast("bigint")


def permuted_pair(a: Column, b: Column, size_a: int, size_b: int, key: str, kind: str) -> Column:
    """Keyed permutation of the pairs (a, b) below (size_a, size_b); a struct of bigint a, b."""
    start = F.struct(a.cast("bigint").alias("a"), b.cast("bigint").alias("b"))
    def turn(s, i):
        odd = i % 2 == 1
        left = F.when(odd, s["a"]).otherwise((s["a"] + _hex(_prf(key, kind, i, s["b"].cast("string")), 1, 14)) % size_a)
        right = F.when(odd, (s["b"] + _hex(_prf(key, kind, i, s["a"].cast("string")), 1, 14)) % size_b).otherwise(s["b"])
        return F.struct(left.alias("a"), right.alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def permuted_symbols(values: Column, sizes: Column, key: str, kind: str) -> Column:
    """Keyed permutation of arrays of symbol numbers: symbol j stays below sizes[j]."""
    return _let(F.struct(values.cast("array<bigint>").alias("v"), sizes.cast("array<bigint>").alias("s")),
                lambda x: _permuted_symbols(x["v"], x["s"], key, kind))


def _permuted_symbols(values: Column, sizes: Column, key: str, kind: str) -> Column:
    half = F.floor(F.size(values) / 2).cast("int")
    rest = F.size(values) - half
    start = F.struct(F.slice(values, F.lit(1), half).alias("l"), F.slice(values, half + 1, rest).alias("r"))
    def shifted(xs, offset, other, i):
        return _let(_prf(key, kind, i, F.array_join(other.cast("array<string>"), ",")), lambda digest: F.transform(
            xs, lambda x, j: (x + _hex(digest, 1 + 3 * (j % 42), 3) + F.floor(j / 42)) % F.get(sizes, offset + j)))
    def turn(s, i):
        odd = i % 2 == 1
        return F.struct(F.when(odd, s["l"]).otherwise(shifted(s["l"], F.lit(0), s["r"], i)).alias("l"),
                        F.when(odd, shifted(s["r"], half, s["l"], i)).otherwise(s["r"]).alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda done: F.concat(done["l"], done["r"]))


def _chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def _digits(s: Column) -> Column:
    return F.transform(_chars(F.regexp_replace(s, "[^0-9]", "")), lambda c: c.cast("bigint"))


def _put_digits(s: Column, digits: Column) -> Column:
    """``s`` with its digits replaced in order; other characters stay."""
    def put(x):
        before = lambda j: F.size(F.filter(F.slice(x["c"], F.lit(1), j), lambda c: c.rlike("[0-9]")))
        return F.array_join(F.transform(x["c"], lambda c, j: F.when(c.rlike("[0-9]"), F.get(x["d"], before(j)).cast("string")).otherwise(c)), "")
    return _let(F.struct(_chars(s).alias("c"), digits.alias("d")), put)


def _tens(xs: Column) -> Column:
    return F.transform(xs, lambda _: F.lit(10))


def _luhn_sum(payload: Column) -> Column:
    """Sum of a card's digits without the check digit, every second one from the right doubled."""
    return F.aggregate(F.transform(F.reverse(payload), lambda d, i: F.when(i % 2 == 0, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d)),
                       F.lit(0).cast("bigint"), lambda a, x: a + x)


def _card(value: Column, key: str) -> Column:
    def swapped(digits):
        payload = F.slice(digits, F.lit(1), F.size(digits) - 1)
        valid = ((_luhn_sum(payload) + F.element_at(digits, -1)) % 10 == 0) & (F.array_max(digits) > 0)
        new = _let(permuted_symbols(payload, _tens(payload), key, "card"), lambda p: F.concat(p, F.array((10 - _luhn_sum(p) % 10) % 10)))
        return F.when(valid, _put_digits(value, new))
    return _let(_digits(value), swapped)


def _mod97(s: Column) -> Column:
    """Remainder of an IBAN's digits, letters as 10 to 35."""
    def step(a, c):
        v = F.when(c.rlike("[0-9]"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return ((a * F.when(v > 9, 100).otherwise(10) + v) % 97).cast("bigint")
    return F.aggregate(_chars(s), F.lit(0).cast("bigint"), step)


def _coded(s: Column) -> tuple[Column, Column]:
    """Numbers and alphabet sizes of characters; what is no ASCII letter or digit is 0 of 1."""
    chars = _chars(s)
    number = F.transform(chars, lambda c: F.when(c.rlike("[0-9]"), F.ascii(c) - 48).when(c.rlike("[a-z]"), F.ascii(c) - 97)
                         .when(c.rlike("[A-Z]"), F.ascii(c) - 65).otherwise(0))
    return number, F.transform(chars, lambda c: F.when(c.rlike("[0-9]"), 10).when(c.rlike("[a-zA-Z]"), 26).otherwise(1))


def _by_class(s: Column, key: str, kind: str) -> Column:
    """Letters become letters of the same case, digits digits; other characters stay."""
    number, sizes = _coded(s)
    return _let(F.struct(_chars(s).alias("c"), permuted_symbols(number, sizes, key, kind).alias("n")), lambda x: F.array_join(F.transform(
        x["c"], lambda c, j: F.when(c.rlike("[0-9]"), F.get(x["n"], j).cast("string")).when(c.rlike("[a-z]"), F.char(F.get(x["n"], j) + 97))
        .when(c.rlike("[A-Z]"), F.char(F.get(x["n"], j) + 65)).otherwise(c)), ""))


def _iban(value: Column, key: str) -> Column:
    head, body = F.substring(value, 1, 2), F.substr(value, F.lit(5))
    valid = _mod97(F.concat(body, F.substring(value, 1, 4))) == 1
    return F.when(valid, _let(_by_class(body, key, "iban"), lambda new: F.concat(
        head, F.lpad((98 - _mod97(F.concat(new, head, F.lit("00")))).cast("string"), 2, "0"), new)))


def _phone(value: Column, key: str) -> Column:
    code = F.regexp_extract(value, r"^(\+[0-9]{1,3}(?=[ .(-]))?", 0)
    body = F.substr(value, F.length(code) + 1)
    return F.concat(code, _let(_digits(body), lambda d: _put_digits(body, permuted_symbols(d, _tens(d), key, "phone"))))


def _ssn(value: Column, key: str) -> Column:
    part = lambda i, n: F.substring(value, i, n).cast("bigint")
    area = part(1, 3)
    a = (F.when(area > 666, area - 2).otherwise(area - 1)) * 99 + part(5, 2) - 1
    def shown(p):
        area = F.floor(p["a"] / 99)
        area = F.when(area >= 665, area + 2).otherwise(area + 1)
        return F.concat_ws("-", F.lpad(area.cast("string"), 3, "0"), F.lpad((p["a"] % 99 + 1).cast("string"), 2, "0"),
                           F.lpad((p["b"] + 1).cast("string"), 4, "0"))
    return _let(permuted_pair(a, part(8, 4) - 1, SSN_A, SSN_B, key, "ssn"), shown)


def _date(value: Column, key: str) -> Column:
    iso = value.contains("-")
    day = F.when(iso, F.try_to_date(value, "yyyy-MM-dd")).otherwise(F.try_to_date(value, "dd/MM/yyyy"))
    first = F.lit(FIRST_DAY).cast("date")
    def moved(n):
        new = _let(permuted_pair(F.floor(n / DAYS_B), n % DAYS_B, DAYS_A, DAYS_B, key, "date"),
                   lambda p: F.date_add(first, (p["a"] * DAYS_B + p["b"]).cast("int")))
        return _let(new, lambda d: F.when(iso, F.date_format(d, "yyyy-MM-dd")).otherwise(F.date_format(d, "dd/MM/yyyy")))
    return F.when(day.isNotNull(), _let(F.datediff(day, first), moved))


def _ip(value: Column, key: str) -> Column:
    part = lambda i: F.split_part(value, F.lit("."), F.lit(i)).cast("bigint")
    p = permuted_pair(part(1) * 256 + part(2), part(3) * 256 + part(4), 65536, 65536, key, "ip")
    return _let(p, lambda p: F.concat_ws(".", *[x.cast("string") for x in (F.floor(p["a"] / 256), p["a"] % 256, F.floor(p["b"] / 256), p["b"] % 256)]))


def _email(value: Column, key: str) -> Column:
    local = F.regexp_extract(value, "^([^@]*)@", 1)
    return F.concat(_by_class(local, key, "email"), F.substr(value, F.length(local) + 1))


def _secret(value: Column, key: str) -> Column:
    number = F.transform(_chars(value), lambda c: F.conv(c, 16, 10).cast("bigint"))
    new = _let(number, lambda n: F.array_join(F.transform(permuted_symbols(n, F.transform(n, lambda _: F.lit(16)), key, "secret"), lambda v: F.hex(v)), ""))
    return _let(new, lambda n: F.when(value == F.lower(value), F.lower(n)).otherwise(n))


PERMUTE = {"email": _email, "iban": _iban, "phone": _phone, "ssn": _ssn, "date": _date, "ip": _ip, "card": _card, "secret": _secret}


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of one found value: of the first format that it fits and validates in; null if there is none."""
    return F.coalesce(*[F.when(_is(kind, value), f(value, key)) for kind, f in PERMUTE.items()])


def pseudonymise(docs: DataFrame, key: str = DEFAULT_KEY, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with personal data in ``text_col`` replaced by keyed pseudonyms of the same format.

    Found and validated: e-mail addresses, IBANs (check digits), phone numbers, social security
    numbers (number ranges), dates (calendar, 1900 to 2099), IPv4 addresses, card numbers (Luhn)
    and hexadecimal secrets of 32 digits or more (with a digit; one of mixed case becomes upper case). Each value runs through an alternating Feistel network on its own
    digits, letters or ranges, with check digits computed anew, so a valid value becomes another
    valid value, and equal values get equal pseudonyms in every document. Values that do not
    validate stay. ``count_col`` adds the number of replaced values.

    One pass with no shuffle; texts without a digit or ``@`` skip all expressions. Null texts stay
    null (count 0), other columns stay as they are.
    """
    def swapped(x):
        pairs = F.transform(x["found"], lambda v, i: F.concat(F.get(x["between"], i), F.coalesce(F.get(x["new"], i), v)))
        return F.struct(F.concat(F.array_join(pairs, ""), F.element_at(x["between"], -1)).alias("text"),
                        F.size(F.filter(x["new"], lambda v: v.isNotNull())).alias("n"))

    def found(text):
        return _let(F.regexp_extract_all(text, F.lit(ANY), F.lit(0)), lambda f: _let(F.struct(
            f.alias("found"), F.transform(f, lambda v: pseudonym(v, key)).alias("new"), F.split(text, ANY).alias("between")), swapped))

    text = F.col(text_col)
    row = docs.select(F.struct(*docs.columns).alias("row"),
                      F.when(text.rlike("[0-9@]") & text.rlike(ANY), found(text)).alias("done"))
    new = F.coalesce(F.col("done.text"), F.col("row")[text_col])
    cols = [new.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns]
    if count_col:
        cols.append(F.coalesce(F.col("done.n"), F.lit(0)).alias(count_col))
    return row.select(*cols)
