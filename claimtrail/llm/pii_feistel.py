"""Pseudonyms for personal data by keyed, format-preserving permutations, with SQL functions only.

One regular expression finds candidates; a candidate that validates is replaced by another valid value of its format. Numbers and dates
are split into two halves ``a`` and ``b`` of sizes ``ma`` and ``mb``, and eight Feistel rounds add a keyed hash of one half to the other
modulo its size: a permutation of all ``ma * mb`` values, so equal values get equal pseudonyms in every document, and different
values different ones. Without the key no value can be traced back.

=========  =====================================  ===================================================
kind       valid                                  permuted
=========  =====================================  ===================================================
card       13-19 digits with a Luhn check digit   all digits but the first; new check digit
iban       two check digits modulo 97             the account's digits; new check digits
ssn        area 001-899 without 666, no part zero area, group and serial number among the valid ones
phone      North American, or + and 8-15 digits   area, exchange and line among the valid ones; others: all digits but two
ip         four numbers up to 255                 all 32 bits
date       1801-01-01 to 2200-12-31               the day among the 146,097 days of these 400 years
email      local part, @, two labels or more      letters and digits but the last label's, by a keyed hash of the address
=========  =====================================  ===================================================

Separators, brackets and padding stay. A day/month date is read day first if that is a date, else month first.

Defined cases: a null text stays null, with no values; an empty text stays empty. Candidates that don't validate, and everything
else, stay as they are. Rows are treated one by one, so repeated rows agree. Other columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from claimtrail.llm.columns import pack, unpack

KEY = "change-me"  # a deployment passes its own
ROUNDS = 8
KINDS = ("card", "iban", "ssn", "phone", "ip", "date", "email")

_CARD = "[0-9]{13,19}|[0-9]{4} [0-9]{4} [0-9]{4} [0-9]{4}|[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{4}|[0-9]{4} [0-9]{6} [0-9]{5}|[0-9]{4}-[0-9]{6}-[0-9]{5}"
#: Characters of an account number after its country and check digits, by country.
_IBAN_SIZES = {
    11: "NO", 12: "BE", 14: "DK FI FK FO GL NL SD", 15: "MK SI", 16: "AT BA EE KZ LT LU MN XK", 17: "CH HR LI LV",
    18: "BG BH CR DE GB GE IE ME RS VA", 19: "AE GI IL IQ OM SO TL", 20: "AD CZ ES MD PK RO SA SE SK TN VG",
    21: "AO CV GW LY MZ PT ST", 22: "DZ IR IS TR", 23: "BI CF CG CM DJ FR GA GQ GR IT KM MC MG MR SM TD",
    24: "AL AZ BF BJ BY CI CY DO GT HN HU LB MA ML NE NI PL SN SV TG", 25: "BR EG PS QA UA", 26: "JO KW MU YE", 27: "MT SC", 28: "LC", 29: "RU",
}
#: A number ends where its country's length says, whatever word follows; one of no listed length goes on as far as it can.
_IBAN = (
    "(?=[A-Z]{2}[0-9]{2})(?:"
    + "".join(f"(?:{c.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{n // 4}}}" + f" ?[A-Z0-9]{{{n % 4}}}" * (n % 4 > 0) + "(?![A-Z0-9])|" for n, c in _IBAN_SIZES.items())
    + "[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)"
)
_SSN = "[0-9]{3}-[0-9]{2}-[0-9]{4}"
_PHONE = "(?:[+]?1[ .-]?)?(?:[(][0-9]{3}[)] ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}|[+][2-9][0-9]{0,2}(?:[ .-]?[(]?[0-9]{2,4}[)]?){2,4}"
_IP = "[0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}"
_ISO = "[0-9]{4}-[0-9]{2}-[0-9]{2}"
_DATE = "[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}[.][0-9]{1,2}[.][0-9]{4}|[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}"
_EMAIL = "[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+"
#: A candidate starts and ends where no word, number or longer value goes on.
_FIND = (
    f"(?<![A-Za-z0-9._%+-]){_EMAIL}"
    f"|(?<![A-Za-z0-9_+.-])(?:{_ISO}|{_DATE}|{_IP}|{_SSN}|{_PHONE}|{_IBAN}|{_CARD})(?![A-Za-z0-9_]|[.-][0-9])"
)
#: What every candidate holds.
_MAY = "[0-9]{2}|@|[0-9][.][0-9]"


def _lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(value: str, name: str, body: str) -> str:
    """SQL for ``body`` with ``name`` bound to ``value``, computed once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


class _Sql:
    """SQL text of the pseudonym of a candidate ``m``."""

    def __init__(self, key: str):
        self.key = key

    def feistel(self, kind: str, a: str, b: str, ma: str, mb: str) -> str:
        """SQL for a struct (a, b): the permuted halves."""
        noise = lambda half: f"cast(conv(substr(sha2(concat_ws(':', {_lit(self.key)}, '{kind}', i, {half}), 256), 1, 15), 16, 10) as bigint)"
        even = f"named_struct('a', pmod(s.a + {noise('s.b')}, {ma}), 'b', s.b)"
        odd = f"named_struct('a', s.a, 'b', pmod(s.b + {noise('s.a')}, {mb}))"
        start = f"named_struct('a', cast({a} as bigint), 'b', cast({b} as bigint))"
        return f"aggregate(sequence(0, {ROUNDS - 1}), {start}, (s, i) -> if(i % 2 = 0, {even}, {odd}))"

    def digits(self, kind: str, text: str) -> str:
        """SQL for the permuted string of two to thirty digits."""
        size = f"cast(length({text}) div 2 as int)"
        rest = f"cast(length({text}) - length({text}) div 2 as int)"
        power = lambda n: f"cast(concat('1', repeat('0', {n})) as bigint)"
        halves = self.feistel(kind, f"substr({text}, 1, {size})", f"substr({text}, {size} + 1)", power(size), power(rest))
        return _let(halves, "p", f"concat(lpad(p.a, {size}, '0'), lpad(p.b, {rest}, '0'))")

    @staticmethod
    def luhn(digits: str) -> str:
        """SQL for the Luhn sum of a string of digits, the last of which has weight one."""
        d = f"cast(substr({digits}, length({digits}) - k, 1) as int)"
        return f"aggregate(sequence(0, cast(length({digits}) as int) - 1), 0, (t, k) -> t + if(k % 2 = 0, {d}, if({d} > 4, 2 * {d} - 9, 2 * {d})))"

    @staticmethod
    def put_back(m: str, digits: str) -> str:
        """SQL for ``m`` with its digits replaced in order."""
        char = f"substr({m}, j, 1)"
        nth = f"cast(length(regexp_replace(substr({m}, 1, j), '[^0-9]', '')) as int)"
        return f"array_join(transform(sequence(1, cast(length({m}) as int)), j -> if({char} between '0' and '9', substr({digits}, {nth}, 1), {char})), '')"

    def card(self) -> str:
        body = self.digits("card", "substr(d, 2, cast(length(d) as int) - 2)")
        new = _let(f"concat(substr(d, 1, 1), {body})", "q", f"concat(q, cast(pmod(10 - {self.luhn('concat(q, 0)')} % 10, 10) as string))")
        return _let("regexp_replace(m, '[^0-9]', '')", "d", f"if(({self.luhn('d')}) % 10 = 0 and d rlike '[1-9]', {_let(new, 'n', self.put_back('m', 'n'))}, m)")

    @staticmethod
    def mod97(text: str) -> str:
        """SQL for the remainder of an account number with its first four characters put last."""
        moved = f"concat(substr({text}, 5), substr({text}, 1, 4))"
        value = "if(c between '0' and '9', t * 10 + cast(c as int), t * 100 + ascii(c) - 55)"
        return f"aggregate(filter(split({moved}, ''), c -> c <> ''), cast(0 as bigint), (t, c) -> ({value}) % 97)"

    def iban(self) -> str:
        own = "regexp_replace(substr(w, 5), '[^0-9]', '')"
        new = f"concat(substr(w, 1, 2), '00', {self.put_back('substr(w, 5)', self.digits('iban', own))})"
        checked = _let(new, "q", f"concat(substr(q, 1, 2), lpad(98 - {self.mod97('q')}, 2, '0'), substr(q, 5))")
        spaced = "array_join(transform(sequence(1, cast(length(m) as int)), j -> if(substr(m, j, 1) = ' ', ' ', substr(n, cast(length(replace(substr(m, 1, j), ' ', '')) as int), 1))), '')"
        valid = f"{self.mod97('w')} = 1 and length({own}) between 2 and 30"
        return _let("replace(m, ' ', '')", "w", f"if({valid}, {_let(checked, 'n', spaced)}, m)")

    def ssn(self) -> str:
        area, group, serial = "cast(substr(m, 1, 3) as int)", "cast(substr(m, 5, 2) as int)", "cast(substr(m, 8) as int)"
        halves = self.feistel("ssn", f"if({area} < 666, {area} - 1, {area} - 2)", f"({group} - 1) * 9999 + {serial} - 1", "898", "989901")
        new = "concat_ws('-', lpad(if(p.a < 665, p.a + 1, p.a + 2), 3, '0'), lpad(p.b div 9999 + 1, 2, '0'), lpad(p.b % 9999 + 1, 4, '0'))"
        return f"if({area} between 1 and 899 and {area} <> 666 and {group} > 0 and {serial} > 0, {_let(halves, 'p', new)}, m)"

    def phone(self) -> str:
        area, exchange = "cast(substr(t, 1, 3) as int)", "cast(substr(t, 4, 3) as int)"
        a, b = f"({area} - 200) * 100 + cast(substr(t, 7, 2) as int)", f"({exchange} - 200) * 100 + cast(substr(t, 9, 2) as int)"
        valid = _let(self.feistel("phone", a, b, "80000", "80000"), "p", "concat(p.a div 100 + 200, p.b div 100 + 200, lpad(p.a % 100, 2, '0'), lpad(p.b % 100, 2, '0'))")
        ten = f"if({area} > 199 and {exchange} > 199, {valid}, {self.digits('phone', 't')})"
        national = f"concat(substr(d, 1, cast(length(d) as int) - 10), {_let('right(d, 10)', 't', ten)})"
        abroad = f"concat(substr(d, 1, 2), {self.digits('phone', 'substr(d, 3)')})"
        new = f"if(m rlike '^[+][2-9]', if(length(d) between 8 and 15, {abroad}, d), {national})"
        return _let("regexp_replace(m, '[^0-9]', '')", "d", _let(new, "n", self.put_back("m", "n")))

    def ip(self) -> str:
        part = lambda k: f"cast(element_at(o, {k}) as int)"
        halves = self.feistel("ip", f"{part(1)} * 256 + {part(2)}", f"{part(3)} * 256 + {part(4)}", "65536", "65536")
        new = _let(halves, "p", "concat_ws('.', p.a div 256, p.a % 256, p.b div 256, p.b % 256)")
        return _let("split(m, '[.]')", "o", f"if(forall(o, x -> cast(x as int) < 256), {new}, m)")

    def _day(self, day: str) -> str:
        """SQL for the permuted day; null stays null."""
        place = f"datediff({day}, date'1801-01-01')"
        halves = self.feistel("date", f"{place} div 773", f"{place} % 773", "189", "773")
        return f"if({place} between 0 and 146096, {_let(halves, 'p', 'date_add(date' + repr('1801-01-01') + ', cast(p.a * 773 + p.b as int))')}, null)"

    def iso(self) -> str:
        return f"coalesce(cast({_let('try_cast(m as date)', 'y', self._day('y'))} as string), m)"

    def date(self) -> str:
        day_first = "concat_ws('-', element_at(o, 3), lpad(element_at(o, 2), 2, '0'), lpad(element_at(o, 1), 2, '0'))"
        month_first = "concat_ws('-', element_at(o, 3), lpad(element_at(o, 1), 2, '0'), lpad(element_at(o, 2), 2, '0'))"
        part = lambda k, name: f"if(length(element_at(o, {k})) = 2, date_format(z, '{name * 2}'), date_format(z, '{name}'))"
        mark = "regexp_extract(m, '[^0-9]', 0)"
        year = "lpad(date_format(z, 'y'), 4, '0')"
        write = lambda first, second: f"concat({part(1, first)}, {mark}, {part(2, second)}, {mark}, {year})"
        found = lambda text, first, second: _let(_let(f"try_cast({text} as date)", "y", self._day("y")), "z", f"if(z is null, null, {write(first, second)})")
        return _let("split(m, '[^0-9]')", "o", f"coalesce({found(day_first, 'd', 'M')}, if(try_cast({day_first} as date) is null, {found(month_first, 'M', 'd')}, null), m)")

    def email(self) -> str:
        last = "length(m) - length(substring_index(m, '.', -1))"
        value = "cast(conv(substr(h, 1 + pmod(2 * j, 62), 2), 16, 10) as int)"
        char = "substr(m, j, 1)"
        new = f"if(j > {last}, {char}, if({char} between '0' and '9', cast({value} % 10 as string), if({char} rlike '[A-Za-z]', char(97 + {value} % 26), {char})))"
        return _let(f"sha2(concat_ws(':', {_lit(self.key)}, 'email', lower(m)), 256)", "h", f"array_join(transform(sequence(1, cast(length(m) as int)), j -> {new}), '')")

    def kind(self) -> str:
        full = lambda pattern: f"m rlike {_lit(f'^(?:{pattern})$')}"
        return (
            f"case when m like '%@%' then 'email' when {full(_CARD)} then 'card' when {full(_IP)} then 'ip' when {full(_ISO)} then 'iso'"
            f" when {full(_DATE)} then 'date' when {full(_SSN)} then 'ssn' when {full(_IBAN)} then 'iban' else 'phone' end"
        )

    def pseudonym(self) -> str:
        cases = " ".join(f"when '{k}' then {getattr(self, k)()}" for k in ("email", "card", "ip", "iso", "date", "ssn", "iban", "phone"))
        return f"case kind {cases} end"


def found_values(text: Column | str) -> Column:
    """Array of the candidates of a text."""
    return F.regexp_extract_all(text, F.lit(_FIND), F.lit(0))


def pseudonymised(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with pseudonyms in ``text``, and ``_pii``: the kind of each value that was replaced, in order."""
    sql = _Sql(key)
    replaced = f"transform(_m, m -> {_let(sql.kind(), 'kind', f'named_struct({_lit("kind")}, if(kind = {_lit("iso")}, {_lit("date")}, kind), {_lit("old")}, m, {_lit("new")}, {sql.pseudonym()})')})"
    out = docs.withColumn("_m", F.when(F.col("text").rlike(_MAY), found_values("text")))
    out = out.withColumn("_r", F.when(F.size("_m") > 0, F.expr(replaced)))
    pieces = F.split("text", _FIND, -1)
    joined = F.array_join(F.zip_with(pieces, "_r", lambda piece, r: F.concat(piece, F.coalesce(r["new"], F.lit("")))), "")
    text = F.when(F.col("_r").isNotNull(), joined).otherwise(F.col("text"))
    kinds = F.transform(F.filter("_r", lambda r: r["new"] != r["old"]), lambda r: r["kind"])
    return out.select(*[text.alias("text") if c == "text" else F.col(c) for c in docs.columns], F.coalesce(kinds, F.array().cast("array<string>")).alias("_pii"))


def pseudonymise(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with pseudonyms in ``text``."""
    return unpack(pseudonymised(pack(docs), key), docs.columns)


def digest(docs: DataFrame, key: str = KEY) -> DataFrame:
    """One row per document: how many values of each kind were replaced, and the new text."""
    out = pseudonymised(docs.select("doc_id", "text"), key)
    counts = [F.expr(f"cast(size(filter(_pii, k -> k = '{kind}')) as bigint)").alias(f"n_{kind}") for kind in KINDS]
    return out.select("doc_id", *counts, "text")
