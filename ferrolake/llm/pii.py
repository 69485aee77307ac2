"""Personal data: format-preserving Feistel pseudonyms (operator 5, DataFrame functions only).

One regex finds the places where a candidate may start; a check validates each (Luhn, IBAN remainder, octets,
calendar, number ranges). Cards and IBANs are tried in every length that ends with a group (IBANs first in the
length of their country, then the longest), and a place without a valid candidate takes nothing from the next,
so digits or capitals beside a number do not hide it. From the left, the first valid candidate counts.
Valid ones are written as mixed-radix digits and permuted by a keyed Feistel network within their format, so a
pseudonym is a valid value of the same form, equal values get equal pseudonyms in every document, and
different values never meet. Check digits are worked out anew.

    email   letters and digits of the local part (case and other characters stay, so does the domain)
    iban    letters and digits of the account part
    ip      the four octets
    phone   the ten digits after the country code
    card    all digits but the check digit
    ssn     area, group and serial number
    date    days from 1800 to 2199, written as before (Y-m-d, also before the time of a timestamp, d.m.Y, m/d/Y)

Everything is a map over rows: no shuffle, no state; a lost executor costs its tasks only.

Defined results: null text counts as empty; numbers that fail their check and all other text stay as they
are; repeated rows get equal results; an empty table gives an empty result. Columns other than doc_id and
text are passed through by ``pseudonymised`` (but for __found, __parts and __all, which it uses itself) and not
read by the report.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Jobs pass their own secret.
KEY = "demonstration key"
ROUNDS = 8
# After a hyphen a card starts only where up to four groups of digits stand before it (Java wants them written out).
_AFTER = "|".join("[0-9]{{1,12}}-" * n for n in range(1, 5))
_CARD = (r"(?=[0-9])(?:(?<![0-9A-Za-z.-])|(?<=[0-9]-)(?<=(?<![0-9A-Za-z.-])(?:" + _AFTER + r")))[0-9](?:[ -]?[0-9]){{{}}}"
         r"(?![0-9A-Za-z]|(?:-[0-9]{{1,12}}){{1,4}}[A-Za-z])")
_IBAN = r"(?<![A-Za-z0-9])[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{}}}{}(?![A-Za-z0-9])"
# The form of each kind, in the order of preference.
FORMS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}",
    "iban": _IBAN.format("2,7", "(?: ?[A-Z0-9]{1,3})?"),
    "ip": r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])",
    "phone": r"(?<![0-9A-Za-z+])\+[0-9]{1,3}[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9A-Za-z])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|-[0-9])",
    "date": r"(?<![0-9A-Za-z./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9A-SU-Za-su-z]|[Tt](?![0-9]))|"
            r"(?:[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9A-Za-z]))",
    "card": _CARD.format("12,18"),
}
KINDS = list(FORMS)
_START = "(?=" + "|".join(f"(?:{x})" for x in FORMS.values()) + ")"
#: What is tried at a start, longest first.
_TRIED = {k: [x] for k, x in FORMS.items()} | {
    "card": [_CARD.format(n - 1) for n in range(19, 12, -1)],
    "iban": [_IBAN.format(n, f"(?: ?[A-Z0-9]{{{t}}})" if t else "") for n in range(7, 1, -1) for t in (3, 2, 1, 0)]}
_MAYBE = {"card": "^[0-9]", "iban": "^[A-Z]{2}[0-9]{2}"}
#: No candidate is longer than so many code points, nor holds so many starts.
_WINDOW, _STARTS = 700, 80
#: Pieces of a text that are gone through before their finds are appended.
_BLOCK = 256
_PIECE = "struct<hit:struct<kind:int,old:string>,start:int,end:int,rest:string>"
_IBAN_SIZES = {int(n): names.split() for n, names in (x.split(":") for x in (
    "15:NO|16:BE|18:DK FI FK FO GL NL SD|19:MK SI|20:AT BA EE KZ LT LU MN XK|21:CH HR LI LV|22:BG BH CR DE GB GE IE ME RS VA|"
    "23:AE GI IL IQ OM SO TL|24:AD CZ ES MD PK RO SA SE SK TN VG|25:LY PT ST|26:IS TR|27:BI DJ FR GR IT MC MR SM|"
    "28:AL AZ BY CY DO GT HN HU LB NI PL SV|29:BR EG PS QA UA|30:JO KW MU YE|31:MT SC|32:LC|33:RU").split("|"))}
_DATES = {r"^[0-9]{4}-": "yyyy-MM-dd", r"^[0-9]{2}\.": "dd.MM.yyyy", r"^[0-9]{2}/": "MM/dd/yyyy"}
_DAY0, _DAYS = "1800-01-01", (27, 5411)  # 400 years are 27 * 5411 days


def _all(s: Column, regex: str) -> Column:
    return F.regexp_extract_all(s, F.lit(regex), F.lit(0))


def _ints(strings: Column) -> Column:
    return F.transform(strings, lambda x: x.cast("int"))


def _radices(*sizes: int) -> Column:
    return F.array(*(F.lit(n) for n in sizes))


def permuted(values: Column, radices: Column, kind: str, key: str) -> Column:
    """Feistel: in turn each half of the digits is shifted by a keyed hash of the other half."""
    half = F.floor(F.size(values) / 2).cast("int")

    def turn(now: Column, r: Column) -> Column:
        left = r % 2 == 0
        other = F.when(left, F.slice(now, half + 1, F.size(now))).otherwise(F.slice(now, 1, half))
        seed = F.concat_ws(":", F.lit(key), F.lit(kind), r.cast("string"), F.array_join(other.cast("array<string>"), ","))

        def digit(x: Column, i: Column) -> Column:
            shift = F.conv(F.substring(F.sha2(F.concat(seed, F.lit("#"), i.cast("string")), 256), 1, 12), 16, 10).cast("long")
            return F.when((i < half) == left, F.pmod(x + shift, F.get(radices, i))).otherwise(x).cast("int")

        return F.transform(now, digit)

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), values.cast("array<int>"), turn)


def _refilled(s: Column, regex: str, new: Column) -> Column:
    """``s`` with its matches of a one-character regex replaced one by one."""
    return F.array_join(F.zip_with(F.split(s, regex, -1), new, lambda gap, x: F.concat(gap, F.coalesce(x, F.lit("")))), "")


_SIGN = r"[a-z]|[A-Z]|[0-9]"


def _signs(s: Column, kind: str, key: str) -> Column:
    """Letters and digits of ``s`` permuted, each within its own kind."""
    signs = _all(s, _SIGN)
    base = lambda c: F.when(c >= "a", 97).when(c >= "A", 65).otherwise(48)
    values = F.transform(signs, lambda c: F.ascii(c) - base(c))
    radices = F.transform(signs, lambda c: F.when(c >= "A", 26).otherwise(10))
    new = F.zip_with(signs, permuted(values, radices, kind, key), lambda c, v: F.char((base(c) + v).cast("long")))
    return _refilled(s, _SIGN, new)


def _luhn(digits: Column) -> Column:
    """The sum that is 0 modulo 10 for a valid number."""
    each = F.transform(F.reverse(digits), lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10


def _mod97(s: Column) -> Column:
    """The remainder of an IBAN's characters, account part first, letters as 10 to 35."""
    return F.aggregate(_all(s, "[A-Z0-9]"), F.lit(0), lambda a, c: F.when(
        c >= "A", a * 100 + F.ascii(c) - 55).otherwise(a * 10 + F.ascii(c) - 48) % 97)


def _email(m: Column, key: str) -> tuple[Column, Column]:
    local = F.substring_index(m, "@", 1)
    return F.lit(True), F.concat(_signs(local, "email", key), F.lit("@"), F.substring_index(m, "@", -1))


def _iban(m: Column, key: str) -> tuple[Column, Column]:
    country, account = F.substring(m, 1, 2), F.substr(m, F.lit(5))
    new = _signs(account, "iban", key)
    check = F.lpad((98 - _mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
    return _mod97(F.concat(account, F.substring(m, 1, 4))) == 1, F.concat(country, check, new)


def _ip(m: Column, key: str) -> tuple[Column, Column]:
    octets = _ints(F.split(m, r"\."))
    return F.forall(octets, lambda x: x < 256), F.array_join(
        permuted(octets, _radices(256, 256, 256, 256), "ip", key).cast("array<string>"), ".")


def _phone(m: Column, key: str) -> tuple[Column, Column]:
    digits = _ints(_all(m, "[0-9]"))
    lead = F.size(digits) - 10
    new = permuted(F.slice(digits, lead + 1, F.lit(10)), _radices(*[10] * 10), "phone", key)
    return lead > 0, _refilled(m, "[0-9]", F.concat(F.slice(digits, F.lit(1), lead), new).cast("array<string>"))


def _ssn(m: Column, key: str) -> tuple[Column, Column]:
    area, group, serial = (p.cast("int") for p in (F.substring(m, 1, 3), F.substring(m, 5, 2), F.substring(m, 8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = F.when(area > 666, area - 2).otherwise(area - 1)
    new = permuted(F.array(place, group - 1, serial - 1), _radices(898, 99, 9999), "ssn", key)
    whole = F.transform(new, lambda v, i: F.when(i > 0, v + 1).when(v >= 665, v + 2).otherwise(v + 1).cast("string"))
    return valid, F.concat_ws("-", F.lpad(F.get(whole, 0), 3, "0"), F.lpad(F.get(whole, 1), 2, "0"), F.lpad(F.get(whole, 2), 4, "0"))


def _date(m: Column, key: str) -> tuple[Column, Column]:
    day = F.coalesce(*(F.when(F.rlike(m, F.lit(form)), F.to_date(F.try_to_timestamp(m, F.lit(fmt)))) for form, fmt in _DATES.items()))
    n = F.date_diff(day, F.lit(_DAY0).cast("date"))
    new = permuted(F.array(F.floor(n / _DAYS[1]).cast("int"), (n % _DAYS[1]).cast("int")), _radices(*_DAYS), "date", key)
    moved = F.date_add(F.lit(_DAY0).cast("date"), F.get(new, 0) * _DAYS[1] + F.get(new, 1))
    return n.between(0, _DAYS[0] * _DAYS[1] - 1), F.coalesce(
        *(F.when(F.rlike(m, F.lit(form)), F.date_format(moved, fmt)) for form, fmt in _DATES.items()))


def _card(m: Column, key: str) -> tuple[Column, Column]:
    digits = _ints(_all(m, "[0-9]"))
    free = F.slice(digits, F.lit(1), F.size(digits) - 1)
    new = permuted(free, F.transform(free, lambda x: F.lit(10)), "card", key)
    check = (10 - _luhn(F.concat(new, F.array(F.lit(0))))) % 10
    return _luhn(digits) == 0, _refilled(m, "[0-9]", F.concat(new, F.array(check)).cast("array<string>"))


_MAKERS: dict[str, Callable[[Column, str], tuple[Column, Column]]] = {
    "email": _email, "iban": _iban, "ip": _ip, "phone": _phone, "ssn": _ssn, "date": _date, "card": _card}


def _choice(window: Column, key: str) -> Column:
    """struct(kind number, match) of the first valid candidate at the start of ``window``, or null."""
    size = lambda m: F.length(F.replace(m, F.lit(" "), F.lit("")))
    usual = lambda m: F.coalesce(*(F.when(F.substring(m, 1, 2).isin(names), F.lit(n)) for n, names in _IBAN_SIZES.items()))
    choices = []
    for i, kind in enumerate(KINDS):
        tried = F.array(*(F.regexp_extract(window, f"^(?:{x})", 0) for x in _TRIED[kind]))
        valid = F.filter(tried, lambda m: (m != "") & _MAKERS[kind](m, key)[0])  # noqa: B023
        if kind == "iban":
            valid = F.transform(F.array(valid), lambda v: F.concat(F.filter(v, lambda m: size(m) == usual(m)), v))[0]
        first = F.get(valid, 0)
        if kind in _MAYBE:
            first = F.when(F.rlike(window, F.lit(_MAYBE[kind])), first)
        choices.append(F.transform(F.filter(F.array(first), lambda m: m.isNotNull()),
                                   lambda m: F.struct(F.lit(i).alias("kind"), m.alias("old"))))  # noqa: B023
    return F.coalesce(*(F.get(c, 0) for c in choices))


def _named(choice: Column, key: str) -> Column:
    """The replacement of a choice."""
    return F.coalesce(*(F.when(choice["kind"] == i, _MAKERS[kind](choice["old"], key)[1]) for i, kind in enumerate(KINDS)))


def pseudonymised(df: DataFrame, key: str = KEY, text: str = "text") -> DataFrame:
    """``df`` with ``text`` replaced, plus __found array<struct<kind, start, end>> of what was, in code points.

    Three passes over the pieces between places where a candidate may start: the first valid candidate of each; the
    finds, from the left, that no earlier find covers; the pseudonyms of those alone. The second goes through blocks
    of ``_BLOCK`` pieces, so that no array is copied once for every piece.
    """
    df = df.withColumn(text, F.coalesce(text, F.lit("")))
    some = F.rlike(text, F.lit(_START))
    # Each value that a lambda uses goes through one: Spark would work out a column anew for every piece.
    once = lambda value, use: F.get(F.transform(F.array(value), use), 0)

    def chosen(s: Column) -> Column:
        def at(piece: Column, i: Column) -> Column:
            window = F.left(F.array_join(F.slice(s["heads"], i + 1, F.lit(_STARTS)), ""), F.lit(_WINDOW))
            return F.struct(piece.alias("piece"), F.when(i > 0, once(window, lambda w: _choice(w, key))).alias("hit"))

        return F.transform(s["pieces"], at)

    # A space in front: the first piece then never is a start, all others are.
    parts = once(F.split(F.concat(F.lit(" "), text), _START, -1), lambda pieces: once(
        F.struct(pieces.alias("pieces"), F.transform(pieces, lambda x: F.left(x, F.lit(_WINDOW))).alias("heads")), chosen))
    df = df.withColumn("__parts", F.when(some, parts))
    none = F.array().cast(f"array<{_PIECE}>")

    def step(acc: Column, x: Column) -> Column:
        """One piece: what the last find leaves of it, or a find at its start."""
        found = x["hit"].isNotNull() & (acc["at"] >= acc["end"])
        end = F.when(found, acc["at"] + F.length(x["hit"]["old"])).otherwise(acc["end"])
        rest = F.when(end <= acc["at"], x["piece"]).otherwise(F.substr(x["piece"], end - acc["at"] + 1))
        out = F.struct(F.when(found, x["hit"]).alias("hit"), acc["at"].alias("start"), end.alias("end"), rest.alias("rest"))
        return F.struct((acc["at"] + F.length(x["piece"])).alias("at"), end.alias("end"), F.concat(acc["out"], F.array(out)).alias("out"))

    def block(acc: Column, i: Column) -> Column:
        begin = F.struct(acc["at"].alias("at"), acc["end"].alias("end"), none.alias("out"))
        return once(F.aggregate(F.slice("__parts", i * _BLOCK + 1, F.lit(_BLOCK)), begin, step), lambda now: F.struct(
            now["at"].alias("at"), now["end"].alias("end"), F.concat(acc["out"], F.array(now["out"])).alias("out")))

    begin = F.struct(F.lit(-1).alias("at"), F.lit(-1).alias("end"), F.array().cast(f"array<array<{_PIECE}>>").alias("out"))
    blocks = F.sequence(F.lit(0), F.floor((F.size("__parts") - 1) / _BLOCK).cast("int"))
    df = df.withColumn("__all", F.when(some, F.flatten(F.aggregate(blocks, begin, block)["out"])))
    # A null choice gives a null name.
    new = lambda x: F.concat(F.when(x["hit"].isNotNull(), F.coalesce(_named(x["hit"], key), F.lit(""))).otherwise(F.lit("")), x["rest"])
    spans = F.transform(F.filter("__all", lambda x: x["hit"].isNotNull()),
                        lambda x: F.struct(x["hit"]["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    joined = F.substr(F.array_join(F.transform("__all", new), ""), F.lit(2))
    return df.withColumns({"__found": F.coalesce(spans, F.array().cast("array<struct<kind:int,start:int,end:int>>")),
                           text: F.coalesce(joined, text)}).drop("__parts", "__all")


def pii_report(docs: DataFrame, key: str = KEY) -> DataFrame:
    """One row per input row: doc_id, n_found, spans (kind:start:end of the input, by start) and the new text."""
    names = F.array(*(F.lit(k) for k in KINDS))
    spans = F.array_join(F.transform("__found", lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")
    return pseudonymised(docs.select("doc_id", "text"), key).select(
        "doc_id", F.size("__found").cast("long").alias("n_found"), spans.alias("spans"), "text")
