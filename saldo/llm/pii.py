"""Format-preserving pseudonyms for personal data, with DataFrame functions only.

A value that passes its check (Luhn digit, mod 97, octets, calendar, ranges) is a number of a finite domain
a * b. A keyed Feistel network over the two parts, adding modulo a and modulo b in turn, permutes
that domain, and the result is written in the same format: as many digits, the same separators, a
right check digit. Equal values get equal pseudonyms in all documents, different values different
ones, and whoever has the key can compute the inverse.

Not found: phone numbers without separators and +, or in groups other than 3-3-4 without +; dates with
one-digit days or months, two-digit years, names of months, or month first with points or hyphens;
account numbers other than IBAN, IBANs in lower case or separated by other signs than blanks; social
security numbers without hyphens; addresses of IP version 6; names and postal addresses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldo.llm.common import free_name

ROUNDS = 8

#: Lengths of account numbers (IBAN) and the countries that use them.
IBAN = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC",
}

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_BLANK = "[ .-]"
_BANK = "|".join(rf"(?:{c.replace(' ', '|')})\d\d(?: ?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN.items())
#: What is looked for, the first kind that matches at a place; no group is captured.
PATTERNS = {
    "secret": r"(?:token|TOKEN|secret|SECRET|api_key|API_KEY|password|PASSWORD) ?[=:] ?[\"']?[0-9A-Fa-f]{16,64}(?![0-9A-Za-z])",
    "email": r"(?<![A-Za-z0-9._%+@-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9-])",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)",
    "date": r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{4}\.\d{2}\.\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?!\d|[./-]\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?!\d|-\d)",
    # With + and separators up to 13 digits, as a number may follow.
    "phone": rf"(?<![\w+])(?:(?:\+\d{{1,3}}{_BLANK}?)?(?:\(\d{{3}}\){_BLANK}?|\d{{3}}{_BLANK})\d{{3}}{_BLANK}\d{{4}}(?!\d|-\d)"
    r"|\+[1-9](?:\d{7,14}|(?:[ .()/-]{0,2}\d){7,12})(?!\d))",
    "iban": rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}\d\d)(?:{_BANK})(?![A-Za-z0-9])",
    "card": r"(?<![\w.-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){2}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{4,5})(?!\w|-\d)",
}
ANY = "|".join(PATTERNS.values())
#: Documents without this need no search.
HINT = r"\d\d|\d\.\d|@|[=:] ?[\"']?[0-9A-Fa-f]{16}"


class Pseudonyms:
    """SQL expression text for values of each kind under one key."""

    def __init__(self, key: str):
        if not key:
            raise ValueError("an empty key protects nothing")
        self.key = key.replace("\\", "\\\\").replace("'", "\\'")

    def feistel(self, number: str, a: str, b: str, kind: str, rounds: int = ROUNDS) -> str:
        """A permutation of 0 .. a * b - 1; the domain sizes are part of the key."""

        def hashed(part: str) -> str:
            said = f"concat_ws('|', '{self.key}', '{kind}', {a}, {b}, i, {part})"
            return f"cast(conv(substr(sha2({said}, 256), 1, 14), 16, 10) AS bigint)"

        first = f"named_struct('l', pmod(s.l + {hashed('s.r')}, {a}), 'r', s.r)"
        second = f"named_struct('l', s.l, 'r', pmod(s.r + {hashed('s.l')}, {b}))"
        return (
            f"aggregate(sequence(1, {rounds}), named_struct('l', ({number}) div {b}, 'r', pmod({number}, {b})), "
            f"(s, i) -> if(i % 2 = 1, {first}, {second}), s -> s.l * {b} + s.r)"
        )

    def digits(self, text: str, kind: str) -> str:
        """Up to 18 digits of any length kept."""
        half = f"cast(rpad('1', length({text}) div 2 + 1, '0') AS bigint)"
        rest = f"cast(rpad('1', length({text}) - length({text}) div 2 + 1, '0') AS bigint)"
        return f"lpad({self.feistel(f'cast({text} AS bigint)', half, rest, kind)}, length({text}), '0')"

    def symbols(self, text: str, base: int, kind: str, width: int = 10) -> str:
        """A string of lower-case digits of a base: permuted in pieces, each with its own key."""
        piece = f"substr({text}, 1 + {width} * p, {width})"
        size = f"length({piece})"
        low = f"cast(power({base}, {size} div 2) AS bigint)"
        high = f"cast(power({base}, {size} - {size} div 2) AS bigint)"
        number = f"cast(conv({piece}, {base}, 10) AS bigint)"
        # The key of a piece holds its place and the pieces before it.
        tweak = f"{kind}', p, '"
        moved = self.feistel(number, low, high, tweak)
        made = f"lower(lpad(conv(cast({moved} AS string), 10, {base}), {size}, '0'))"
        return f"array_join(transform(sequence(0, (length({text}) - 1) div {width}), p -> {made}), '')"

    # Each of the following maps the whole match m; m is kept where it fails its check.

    def ip(self) -> str:
        octets = "split(m, '[.]')"
        whole = " + ".join(f"cast({octets}[{i}] AS bigint) * {256 ** (3 - i)}" for i in range(4))
        moved = self.feistel(whole, "65536", "65536", "ip")
        parts = ", ".join(f"pmod(x div {256 ** (3 - i)}, 256)" for i in range(4))
        return f"array_join(transform(array({moved}), x -> concat_ws('.', {parts})), '')"

    def date(self) -> str:
        """Days of the 400 years from 1800 on: 146 097 = 189 * 773 of them, permuted among themselves."""
        form = (
            "CASE WHEN m LIKE '____-%' THEN 'yyyy-MM-dd' WHEN m LIKE '____/%' THEN 'yyyy/MM/dd' "
            "WHEN m LIKE '____.%' THEN 'yyyy.MM.dd' WHEN m LIKE '__.%' THEN 'dd.MM.yyyy' ELSE 'dd/MM/yyyy' END"
        )
        iso = (
            "if(m RLIKE '^[0-9]{4}', translate(m, './', '--'), "
            "concat(substr(m, 7, 4), '-', substr(m, 4, 2), '-', substr(m, 1, 2)))"
        )
        day = f"datediff(try_cast({iso} AS date), date'1800-01-01')"
        moved = self.feistel(f"cast({day} AS bigint)", "189", "773", "date")
        new = f"date_format(date_add(date'1800-01-01', cast({moved} AS int)), {form})"
        return f"if({day} BETWEEN 0 AND 146096, {new}, {self._month_first()})"

    def _month_first(self) -> str:
        """MM/dd/yyyy that is no dd/MM/yyyy: the 88 497 = 9 * 9833 days after a 12th, permuted among
        themselves, so that the result is none either. One part is small, hence more rounds."""
        start = "date'1800-01-01'"
        date = "try_cast(concat(substr(m, 7, 4), '-', substr(m, 1, 2), '-', substr(m, 4, 2)) AS date)"
        sound = f"m LIKE '__/%' AND datediff({date}, {start}) BETWEEN 0 AND 146096 AND day({date}) > 12"
        place = f"datediff({date}, {start}) - 12 * ((year({date}) - 1800) * 12 + month({date}))"
        moved = self.feistel(f"cast({place} AS bigint)", "9", "9833", "month first", 4 * ROUNDS)
        # The month: the last of those around the mean place that begins at or before the place.
        mean = "cast(x * 4800 div 88497 AS int)"
        begins = f"datediff(add_months({start}, k), {start}) - 12 * k"
        month = f"array_max(filter(sequence(greatest({mean} - 2, 0), {mean} + 2), k -> {begins} <= x))"
        new = f"date_format(date_add(add_months({start}, k), cast(x - ({begins}) AS int) + 12), 'MM/dd/yyyy')"
        made = f"transform(array({month}), k -> {new})[0]"
        return f"if({sound}, transform(array({moved}), x -> {made})[0], m)"

    def ssn(self) -> str:
        """Areas 001 to 899 but 666, groups 01 to 99, serials 0001 to 9999."""
        area, group, serial = (f"cast(split(m, '-')[{i}] AS bigint)" for i in range(3))
        sound = f"{area} BETWEEN 1 AND 899 AND {area} != 666 AND {group} > 0 AND {serial} > 0"
        number = f"((({area} - if({area} > 666, 2, 1)) * 99 + {group} - 1) * 9999 + {serial} - 1)"
        moved = self.feistel(number, str(898 * 99), "9999", "ssn")
        place = "(x div 9999) div 99"
        parts = (
            f"lpad({place} + if({place} >= 665, 2, 1), 3, '0'), "
            "lpad(pmod(x div 9999, 99) + 1, 2, '0'), lpad(pmod(x, 9999) + 1, 4, '0')"
        )
        return f"if({sound}, array_join(transform(array({moved}), x -> concat_ws('-', {parts})), ''), m)"

    def phone(self) -> str:
        """The digits after the country code."""
        bare = r"regexp_replace(m, '\\D', '')"
        two = "^(?:2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
        code = (
            f"CASE WHEN m NOT LIKE '+%' THEN 0 WHEN {bare} RLIKE '^[17]' THEN 1 "
            f"WHEN {bare} RLIKE '{two}' THEN 2 ELSE 3 END"
        )
        return self._filled(self.digits(f"substr({bare}, 1 + {code})", "phone"), code)

    def iban(self) -> str:
        """The digits after the check digits, which become those of the result; letters stay."""
        bare = "replace(m, ' ', '')"
        country, check, account = f"left({bare}, 2)", f"substr({bare}, 3, 2)", f"substr({bare}, 5)"
        digits = f"regexp_replace({account}, '[A-Z]', '')"
        sound = f"{digits} != '' AND {check} BETWEEN '02' AND '98' AND {_mod97(f'concat({account}, {country}, {check})')} = 1"
        moved = _refill(account, "[0-9]", self.symbols(digits, 10, "iban"), "0")
        again = _mod97(f"concat(x, {country}, '00')")
        made = f"concat({country}, lpad(98 - {again}, 2, '0'), x)"
        new = f"transform(array({moved}), x -> {_refill('m', '[A-Z0-9]', made, '0')})[0]"
        # What is no account number may hold other values.
        rest = {kind: pattern for kind, pattern in PATTERNS.items() if kind != "iban"}
        within = _quoted("|".join(rest.values()))
        parts = f"transform(regexp_extract_all(m, '{within}', 0), m -> {self._by_kind(rest)})"
        other = f"array_join(zip_with(split(m, '{within}', -1), {parts}, (p, n) -> concat(p, coalesce(n, ''))), '')"
        return f"if({sound}, {new}, {other})"

    def card(self) -> str:
        """All digits but the last, which is the check digit of the others."""
        bare = r"regexp_replace(m, '\\D', '')"
        payload = f"substr({bare}, 1, length({bare}) - 1)"
        moved = f"array_join(transform(array({self.digits(payload, 'card')}), x -> concat(x, {_luhn('x')})), '')"
        right = f"{_luhn(payload)} = right({bare}, 1)"
        return f"if({right}, {self._filled(moved, '0')}, m)"

    def email(self) -> str:
        """Letters and digits of the part before the @, in lower case; its other signs stay."""
        local = "substring_index(m, '@', 1)"
        bare = f"lower(regexp_replace({local}, '[^A-Za-z0-9]', ''))"
        moved = self.symbols(bare, 36, "email")
        filled = _refill(local, "[A-Za-z0-9]", moved, "0")
        return f"if({bare} = '', m, concat({filled}, substr(m, length({local}) + 1)))"

    def secret(self) -> str:
        """The hexadecimal digits, in lower case."""
        value = "regexp_extract(m, '[0-9A-Fa-f]{16,64}$', 0)"
        head = f"left(m, length(m) - length({value}))"
        return f"concat({head}, {self.symbols(f'lower({value})', 16, 'secret')})"

    def _filled(self, digits: str, kept: str) -> str:
        """m with its digits replaced in order, but the first so many."""
        return _refill("m", "[0-9]", digits, kept)

    def replace(self) -> str:
        """The pseudonym of any match m."""
        return self._by_kind(PATTERNS)

    def _by_kind(self, patterns: dict[str, str]) -> str:
        cases = " ".join(
            f"WHEN m RLIKE '^(?:{_quoted(pattern)})$' THEN {getattr(self, kind)()}"
            for kind, pattern in patterns.items()
        )
        return f"CASE {cases} ELSE m END"


def _quoted(pattern: str) -> str:
    return pattern.replace("\\", "\\\\").replace("'", "\\'")


def _refill(text: str, sign: str, new: str, kept: str) -> str:
    """text with its signs, after the first so many, replaced by those of new in order."""
    step = (
        f"(s, c) -> if(c RLIKE '{sign}' AND s.seen >= s.kept, "
        "named_struct('out', concat(s.out, substr(s.new, s.seen - s.kept + 1, 1)), 'seen', s.seen + 1, 'kept', s.kept, 'new', s.new), "
        f"named_struct('out', concat(s.out, c), 'seen', if(c RLIKE '{sign}', s.seen + 1, s.seen), 'kept', s.kept, 'new', s.new))"
    )
    start = f"named_struct('out', '', 'seen', 0, 'kept', {kept}, 'new', {new})"
    return f"aggregate(split({text}, ''), {start}, {step}, s -> s.out)"


def _luhn(payload: str) -> str:
    """The check digit that follows a string of digits."""
    doubled = "if(i % 2 = 0, 2 * d - if(d > 4, 9, 0), d)"
    each = f"transform(split(reverse({payload}), ''), (c, i) -> transform(array(cast(c AS int)), d -> {doubled})[0])"
    return f"cast(pmod(-aggregate({each}, 0, (t, d) -> t + d), 10) AS string)"


def _mod97(text: str) -> str:
    """The remainder of a number whose letters stand for 10 to 35."""
    step = "pmod(if(c < 'A', t * 10 + ascii(c) - 48, t * 100 + ascii(c) - 55), 97)"
    return f"aggregate(split({text}, ''), 0, (t, c) -> {step})"


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """docs with the values of the text replaced, and n_replaced, how many there were.

    All rows and columns stay. A null text stays null with 0. Values that fail their check, such as
    16 digits with a wrong last one, are left as they are and not counted. Letters of addresses
    become lower case, so that spellings of one address stay linked. Texts keep their length, but
    for network addresses, whose numbers have one to three digits. Rows are handled one by one,
    so ties, order and repeated rows do not matter; a column of docs named like a result is
    replaced by it.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() == "n_replaced"])
    found, moved = free_name(docs, "pii_found"), free_name(docs, "pii_moved")
    value = F.col(f"`{text}`")
    hit = F.coalesce(value.rlike(HINT), F.lit(False))
    pattern = F.lit(ANY)
    out = docs.withColumn(
        found, F.when(hit, F.regexp_extract_all(value, pattern, F.lit(0))).otherwise(F.array().cast("array<string>"))
    )
    replace = Pseudonyms(key).replace()
    out = out.withColumn(moved, F.expr(f"transform(`{found}`, m -> named_struct('old', m, 'new', {replace}))"))
    pieces = F.split(value, ANY, -1)
    joined = F.array_join(
        F.zip_with(pieces, F.col(f"{moved}.new"), lambda piece, new: F.concat(piece, F.coalesce(new, F.lit("")))), ""
    )
    some = F.size(found) > 0
    return (
        out.withColumn("n_replaced", F.size(F.filter(moved, lambda x: x["old"] != x["new"])).cast("long"))
        .withColumn(text, F.when(some, joined).otherwise(value))
        .drop(found, moved)
    )
