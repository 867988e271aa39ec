"""Surrogates for personal data (operator 1).

Entities are found in the whole text by one ordered alternation and replaced in
place by values of their own kind, format, script and gender, derived from a
secret key. All of it is built-in expressions: ``regexp_extract_all`` and
``split`` by the same pattern give the entities and what stands between them.

An entity's canonical form (digits of a phone number, lower-case address) alone
decides its surrogate, so mentions of one entity agree across documents and
formats. The distinct entities of the corpus are then checked: where two would
share a surrogate, or a surrogate is itself a real entity of the corpus, one
keeps it and the others are derived again with the next attempt number, until
all differ. Later attempts draw from larger spaces (more letters, more
syllables, at last more digits than the format has), so this ends however many
entities crowd a small one. These exceptions, few by the size of the spaces,
are counted before they are used: up to ``MAP_ROWS`` they travel inside the
plan, beyond that they are joined to the rows that hold them.

Persons are found by title. Each word of a name is an entity of its own, given
or family name, so "Mr Adam Smith", "Mr Smith" and, in a text that has one of
them, the bare "Smith" share the family name's surrogate. A given name's gender
is its title's, or after a title for both its ending's.

Kinds: secret (quoted after token/secret/password/key, well-known key prefixes,
long hex), e-mail, IBAN (remainder kept), payment card (one separator, passes
the Luhn check, as its surrogate does), MAC, IPv6, IPv4 (private ranges stay
private), social security number, phone (country code kept), given and family
name after a title (Latin, Cyrillic, Greek; other scripts letter by letter).

Defined results: a null text stays null; an empty text and one without entities
stay as they are; a null ``doc_id`` and repeated rows are treated like any
other; all columns of the input are kept, ``n_chars``, if there, is counted
anew where the text changed; a column of the name ``n_replaced`` is overwritten,
any other name may clash; an empty table gives no rows. Texts of any length are
searched whole: no pattern repeats a group without bound, so none recurses.
"""

from __future__ import annotations

import itertools
import json
import secrets

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import fresh, written

#: Exceptions carried inside the plan, at most.
MAP_ROWS = 2_000
#: Session setting that holds the key.
KEY_SETTING = "spark.threadloom.pii.key"

TITLES = {
    "m": ["Mr", "Mister", "Herr", "Monsieur", "Señor", "Sr", "господин", "Господин", "κύριος", "Κύριος"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "госпожа", "Госпожа", "κυρία", "Κυρία"],
    "n": ["Dr", "Prof", "Professor"],
}
PARTICLES = "von van de del der den da di du la le zu".split()
SCRIPTS = {"cyrillic": "[Ѐ-ӿ]", "greek": "[Ͱ-Ͽ]", "latin": r"\p{IsLatin}"}
SYLLABLES = {
    "latin": "ba be bo da de di do fa fe ga go ha he ka ke ko la le li lo ma me mi mo na ne no ra re ro sa te".split(),
    "cyrillic": "ба бе бо ва ве во да де ди ду га го ка ке ко ла ле ли ло ма ме ми мо на не но ра ре ро са се та".split(),
    "greek": "βα βε βο δα δε δι δο φα φε γα γο κα κε κο λα λε λι λο μα με μι μο να νε νο ρα ρε ρο σα τε".split(),
}
#: Ends of given names by gender, and of family names.
ENDINGS = {
    "latin": {"m": "n rt ld ck".split(), "f": "na lia ra sa".split(), "family": "r n l s".split()},
    "cyrillic": {"m": "н р м л".split(), "f": "на лия ра са".split(), "family": "ров нов лев мин".split()},
    "greek": {"m": "νος ρης λος μης".split(), "f": "να λια ρα σα".split(), "family": "κης δης λος νης".split()},
}

_NAME = r"\p{Lu}(?:\p{L}++|['’]\p{Lu}\p{L}++)(?:['’-]\p{Lu}\p{L}++)*+"
_TITLED = "|".join(sorted((t for ts in TITLES.values() for t in ts), key=len, reverse=True))
_BEFORE_NAME = rf"(?<![\p{{L}}\p{{N}}])(?:{_TITLED})\.? (?:\p{{Lu}}\.? ){{0,2}}(?:(?:{'|'.join(PARTICLES)}) ){{0,2}}"
#: A title with the name that follows.
PERSON = rf"(?=[DFHMPSгГκΚ]){_BEFORE_NAME}{_NAME}(?: {_NAME})?"
_GROUPS = "[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6}"
#: What the kinds look like, most specific first. Java syntax.
PATTERNS = {
    "secret": r"""(?<=["'])(?<=\b(?i:token|secret|password|passwd|pwd|api[_-]?key|access[_-]?key)\s{0,3}[=:]\s{0,3}["'])[^"'\s]{6,}+|\bAKIA[0-9A-Z]{16}\b|\bgh[pousr]_[A-Za-z0-9]{20,}+\b|(?<![\w-])sk-[A-Za-z0-9]{20,}+\b|(?<![\w-])eyJ[\w-]{8,}+\.[\w-]{8,}+\.[\w-]{8,}+|\b(?=[a-f]*+\d)[0-9a-f]{32,}+\b|\b(?=[A-F]*+\d)[0-9A-F]{32,}+\b""",
    "email": r"(?<![\p{L}0-9._%+-])[\p{L}0-9._%+-]++@[\p{L}0-9-]++(?:\.[\p{L}0-9-]++)++",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "mac": r"\b(?:[0-9A-Fa-f]{2}[:-]){5}[0-9A-Fa-f]{2}\b",
    "ipv6": r"\b(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}\b" + rf"|(?<![\w:.])(?=(?:::)?[0-9A-Fa-f])(?!(?:[0-9A-Fa-f]++:++){{7}}[0-9A-Fa-f])(?:{_GROUPS})?::(?:{_GROUPS})?(?![\w:]|\.\d)",
    "card": r"(?<![\w.-])(?:[2-6]\d{12,18}|[2-6]\d{3}(?:(?: \d{4}){2} \d{1,7}|(?:-\d{4}){2}-\d{1,7}| \d{6} \d{5}|-\d{6}-\d{5}))(?![\w-])",
    "ipv4": r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\w)|(?<![\w(])\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\w)|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])",
}
#: What a kind may begin with, where that spares a try at every character.
_FIRST = {"iban": "[A-Z]", "mac": "[0-9A-Fa-f]", "ipv6": "[0-9A-Fa-f:]", "card": r"\d", "ipv4": r"\d", "ssn": r"\d", "phone": r"[+(\d]"}
PATTERN = "|".join(f"(?={_FIRST[k]})(?:{p})" if k in _FIRST else f"(?:{p})" for k, p in PATTERNS.items())
#: Shapes that tell an entity's kind once it is cut out.
_SHAPES = [
    ("email", r"^[\p{L}0-9._%+-]++@[\p{L}0-9-]++(?:\.[\p{L}0-9-]++)++$"),
    ("ipv4", r"^(?:\d{1,3}\.){3}\d{1,3}$"),
    ("mac", r"^(?:[0-9A-Fa-f]{2}[:-]){5}[0-9A-Fa-f]{2}$"),
    ("ipv6", rf"^(?:(?:[0-9A-Fa-f]{{1,4}}:){{7}}[0-9A-Fa-f]{{1,4}}|(?:{_GROUPS})?::(?:{_GROUPS})?)$"),
    ("ssn", r"^\d{3}-\d{2}-\d{4}$"),
    ("iban", r"^[A-Z]{2}\d{2}(?: ?[A-Z0-9]{1,4}){2,8}$"),
    ("phone", r"^(?:\+[\d ().-]+|\(\d{3}\)[\d .-]+|\d{3}[.-]\d{3}[.-]\d{4})$"),
    ("card", r"^[2-6][\d -]{12,24}$"),
]
#: Country calling codes of one and of two digits; the others have three.
_CODES = r"^\+(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"

#: Beginnings that tell what a secret is for; they stay.
_PREFIX = r"^(?:AKIA|gh[pousr]_|sk-|eyJ)"


def _luhn(digits: Column) -> Column:
    return F.call_function("luhn_check", digits)


def kind_of(m: Column) -> Column:
    """The kind of what ``PATTERN`` found; null for digits that are no card."""
    out = None
    for kind, shape in _SHAPES:
        named = F.when(_luhn(F.regexp_replace(m, "[^0-9]", "")), kind) if kind == "card" else F.lit(kind)
        out = F.when(m.rlike(shape), named) if out is None else out.when(m.rlike(shape), named)
    return out.otherwise("secret")


def people(text: Column) -> Column:
    """The words of all names after titles: structs ``m, kind, canon``, each once."""

    def parts(said):
        words = F.split(F.regexp_replace(said, rf"^{_BEFORE_NAME}", ""), " ")
        woman, both = said.rlike(rf"^(?:{'|'.join(TITLES['f'])})\b"), said.rlike(rf"^(?:{'|'.join(TITLES['n'])})\b")
        gender = lambda w: F.when(F.when(both, w.rlike("[aáàâäαάηήаяАЯAΑΗ]$")).otherwise(woman), "f|").otherwise("m|")
        given = F.transform(F.slice(words, 1, F.size(words) - 1), lambda w: F.struct(w.alias("m"), F.lit("given").alias("kind"), F.concat(gender(w), F.lower(w)).alias("canon")))
        family = F.transform(F.slice(words, -1, 1), lambda w: F.struct(w.alias("m"), F.lit("family").alias("kind"), _stem(F.lower(w)).alias("canon")))
        return F.concat(family, given)

    return F.array_distinct(F.flatten(F.transform(F.regexp_extract_all(text, F.lit(PERSON), F.lit(0)), parts)))


_FEMALE = "(?<=ов|ев|ёв|ин|ын)а$"


def _stem(w: Column) -> Column:
    """Russian family names of women in the form of men."""
    return F.regexp_replace(F.regexp_replace(w, _FEMALE, ""), "ская$", "ский")


def _expanded(m: Column) -> Column:
    """The 32 digits of an IPv6 address, however it is written."""
    groups = lambda part: F.filter(F.split(part, ":"), lambda g: g != "")
    left, right = groups(F.substring_index(m, "::", 1)), groups(F.when(m.contains("::"), F.substring_index(m, "::", -1)).otherwise(""))
    every = F.concat(left, F.array_repeat(F.lit("0"), F.lit(8) - F.size(left) - F.size(right)), right)
    return F.lower(F.array_join(F.transform(every, lambda g: F.lpad(g, 4, "0")), ""))


def canonical(kind: Column, m: Column) -> Column:
    """What all mentions of an entity share."""
    bare = F.regexp_replace(m, "[^0-9A-Za-z]", "")
    return (
        F.when(kind.isin("secret", "ipv4"), m)
        .when(kind == "email", F.lower(m))
        .when(kind == "ipv6", _expanded(m))
        .when(kind == "mac", F.lower(bare))
        .when(kind == "phone", F.concat(F.when(m.startswith("+"), "+").otherwise(""), bare))
        .otherwise(bare)
    )


# The surrogates themselves are written as SQL text, which is parsed in one go;
# built call by call they would take seconds before any job starts. ``x`` is an
# entity: its ``kind``, its form ``canon``, the attempt ``n`` and its stream ``s``.


def _q(text: str) -> str:
    return f'r"{text}"' if "'" in text else f"r'{text}'"


def _stream(key: str) -> str:
    """128 hex digits drawn by the key."""
    seed = lambda part: f"sha2(concat_ws('\x1f', {_q(key)}, x.kind, x.canon, cast(x.n as string), '{part}'), 256)"
    return f"concat({seed(0)}, {seed(1)})"


def _draw(i: int | str, stream: str = "x.s") -> str:
    """The i-th number below 65536 of a stream, in rotation."""
    return f"cast(conv(substr({stream}, (({i}) % 62) * 2 + 1, 4), 16, 10) as int)"


def _pick(alphabet: str, n: str) -> str:
    return f"substr('{alphabet}', ({n}) % {len(alphabet)} + 1, 1)"


_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Characters of a script and what takes their place.
_SCRIPTS = [
    ("c BETWEEN '0' AND '9'", _DIGITS),
    ("c BETWEEN 'a' AND 'z'", _LOWER),
    ("c BETWEEN 'A' AND 'Z'", _UPPER),
    ("c BETWEEN 'а' AND 'ё'", "абвгдежзиклмнопрстуфхцчшэюя"),
    ("c BETWEEN 'Ё' AND 'Я'", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"),
    ("c BETWEEN 'ά' AND 'ώ'", "αβγδεζηθικλμνξοπρστυφχψω"),
    ("c BETWEEN 'Ά' AND 'Ϋ'", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"),
    ("c BETWEEN 'ա' AND 'և'", "աբգդեզէըթժիլխծկհձղճմյնշոչպջռսվտրցւփք"),
    ("c BETWEEN 'Ա' AND 'Ֆ'", "ԱԲԳԴԵԶԷԸԹԺԻԼԽԾԿՀՁՂՃՄՅՆՇՈՉՊՋՌՍՎՏՐՑՒՓՔ"),
    ("c BETWEEN '一' AND '鿿'", "安白成达方高海江康林明宁平青瑞山田文新远"),
    (r"c rlike r'\p{Lu}'", "ÀÂÄÇÉÈÊËÎÏÑÔÖÙÛÜ"),
    (r"c rlike r'\p{L}'", "àâäçéèêëîïñôöùûü"),
]


def _shaped(text: str, stream: str = "x.s", first: int = 0, hexadecimal: bool = False) -> str:
    """Each character of ``text`` from ``first`` on replaced by one of its script."""
    n = _draw("i", stream)
    hexes = [("c BETWEEN '0' AND '9' OR c BETWEEN 'a' AND 'f'", "0123456789abcdef"), ("c BETWEEN 'A' AND 'F'", "0123456789ABCDEF")] if hexadecimal else []
    cases = " ".join(f"WHEN {when} THEN {_pick(alphabet, n)}" for when, alphabet in hexes + _SCRIPTS)
    return f"array_join(transform(split({text}, ''), (c, i) -> CASE WHEN i < {first} THEN c {cases} ELSE c END), '')"


def _more(n: str, alphabet: str) -> str:
    """``n`` characters by which a later attempt is longer; none for n <= 0."""
    return f"if({n} > 0, array_join(transform(sequence(1, greatest({n}, 1)), i -> {_pick(alphabet, _draw('i + 30'))}), ''), '')"


def _of(words: list[str], n: str) -> str:
    return f"element_at(split('{' '.join(words)}', ' '), {n} % {len(words)} + 1)"


def _person() -> str:
    """A given or family name of the script of ``canon``, lower case."""
    name = "substring_index(x.canon, '|', -1)"
    cases = []
    for script, shape in SCRIPTS.items():
        ends, parts = ENDINGS[script], SYLLABLES[script]
        word = lambda who, at: f"concat(array_join(transform(sequence(1, 3 + x.n), i -> {_of(parts, _draw(f'i * 5 + {at}'))}), ''), {_of(ends[who], _draw(at))})"  # noqa: B023, E731
        family = f"if({name} LIKE '%-%', concat_ws('-', {word('family', 0)}, {word('family', 31)}), {word('family', 0)})"
        cases.append(f"WHEN {name} rlike {_q(shape)} THEN CASE WHEN x.kind = 'family' THEN {family} WHEN x.canon LIKE 'f|%' THEN {word('f', 0)} ELSE {word('m', 0)} END")
    longer = f"repeat(substr({name}, 1, 1), x.n)"
    other = f"concat({_shaped(name)}, {_shaped(longer, 'reverse(x.s)')})"
    return f"concat(if(x.kind = 'given', concat(substring_index(x.canon, '|', 1), '|'), ''), CASE {' '.join(cases)} ELSE {other} END)"


def _remainder(iban: str) -> str:
    """The number modulo 97 that the standard asks to be 1."""
    turned = f"upper(concat(substr({iban}, 5), substr({iban}, 1, 4)))"
    return f"aggregate(split({turned}, ''), 0, (a, c) -> CASE WHEN c = '' THEN a WHEN c BETWEEN '0' AND '9' THEN (a * 10 + cast(c as int)) % 97 ELSE (a * 100 + cast(conv(c, 36, 10) as int)) % 97 END)"


def _once(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` for a value worked out once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _surrogate() -> str:
    """The canonical form of the entity's replacement."""
    late = _more("x.n - 8", _DIGITS)  # the format is given up last
    host, tld = "substring_index(x.canon, '@', -1)", r"regexp_extract(x.canon, r'\.(com|org|net)$', 1)"
    local, domain = "substring_index(x.canon, '@', 1)", f"substring_index({host}, '.', 1)"
    email = f"concat({_shaped(local)}, {_more('x.n', _LOWER)}, '@', {_shaped(domain, 'reverse(x.s)')}, '.example.', if({tld} = '', 'com', {tld}))"
    body = f"concat({_shaped('substr(x.canon, 1, length(x.canon) - 1)', first=1)}, {late})"
    card = _once(body, "b", "concat(b, get(filter(array('0', '1', '2', '3', '4', '5', '6', '7', '8', '9'), d -> luhn_check(concat(b, d))), 0))")
    octet = {at: f"cast({_draw(at)} % {most} + {least} as string)" for at, least, most in ((0, 11, 100), (4, 0, 256), (8, 0, 256), (12, 1, 254))}
    # the small private ranges may be full: later attempts go to the large one
    private = r"if(x.n > 8 and p != '', '10.', p)"
    range_ = r"regexp_extract(x.canon, r'^(?:10\.|127\.|192\.168\.|172\.(?:1[6-9]|2\d|3[01])\.)', 0)"
    ipv4 = _once(range_, "p", _once(private, "q", f"concat(q, concat_ws('.', if(q = '', {octet[0]}, null), if(q = '' or length(q) <= 4, {octet[4]}, null), {octet[8]}, {octet[12]}), if(x.n > 24, concat('.', {_more('x.n - 24', _DIGITS)}), ''))"))
    ssn = f"concat(cast(100 + {_draw(0)} % 566 as string), lpad(cast(1 + {_draw(4)} % 99 as string), 2, '0'), lpad(cast(1 + {_draw(8)} % 9999 as string), 4, '0'), {late})"
    phone = _once(f"regexp_extract(x.canon, {_q(_CODES)}, 0)", "o", f"concat(o, {_shaped('substr(x.canon, length(o) + 1)')}, {late})")
    # a remainder of 1 stays 1, any other stays another
    unchecked = "concat(substr(x.canon, 1, 2), '00', g)"
    digits = f"lpad(cast(98 - {_remainder(unchecked)} - if({_remainder('x.canon')} = 1, 0, 1) as string), 2, '0')"
    iban = _once(f"concat({_shaped('substr(x.canon, 5)')}, {late})", "g", f"concat(substr(x.canon, 1, 2), {digits}, g)")
    shaped_secret = _shaped(f"regexp_replace(x.canon, {_q(_PREFIX)}, '')")
    secret = f"concat(regexp_extract(x.canon, {_q(_PREFIX)}, 0), {shaped_secret}, {late})"
    return f"""CASE x.kind WHEN 'email' THEN {email} WHEN 'card' THEN {card} WHEN 'ipv4' THEN {ipv4} WHEN 'ssn' THEN {ssn} WHEN 'phone' THEN {phone} WHEN 'iban' THEN {iban}
        WHEN 'mac' THEN {_shaped('x.canon', hexadecimal=True)} WHEN 'ipv6' THEN {_shaped('x.canon', hexadecimal=True)} WHEN 'given' THEN {_person()} WHEN 'family' THEN {_person()}
        ELSE if(x.canon rlike r'^(?:(?=[0-9]*+[a-f])[0-9a-f]{{16,}}+|(?=[0-9]*+[A-F])[0-9A-F]{{16,}}+)$', concat({_shaped('x.canon', hexadecimal=True)}, {late}), {secret}) END"""


def _dressed() -> str:
    """The replacement ``x.fake`` in the format of the mention ``x.m``."""
    bare = r"regexp_replace(substring_index(x.fake, '|', -1), r'^\+', '')"
    # each letter or digit takes the next of the replacement, which ends behind the last
    slots = "length(regexp_replace(x.m, '[^0-9A-Za-z]', ''))"
    step = "CASE WHEN c rlike '[A-Z]' THEN concat(a, upper(substr(b, K, 1))) WHEN c rlike '[0-9a-z]' THEN concat(a, substr(b, K, 1)) ELSE concat(a, c) END"
    step = step.replace("K", "length(regexp_replace(substr(x.m, 1, i + 1), '[^0-9A-Za-z]', ''))").replace("concat(a, ", "concat('', ")
    full = _once(bare, "b", f"concat(array_join(transform(split(x.m, ''), (c, i) -> {step}), ''), substr(b, {slots} + 1))")
    feminine = f"if(lower(x.m) rlike {_q(_FEMALE + '|ская$')}, 'а', '')"
    name = _once(f"concat({bare}, {feminine})", "b", "if(upper(x.m) = x.m, upper(b), array_join(transform(split(b, '-'), w -> initcap(w)), '-'))")
    eight = "regexp_replace(x.fake, '(.{4})(?=.)', '$1:')"
    return f"""CASE WHEN x.kind IS NULL THEN x.m WHEN x.kind IN ('secret', 'email', 'ipv4') THEN x.fake WHEN x.kind IN ('given', 'family') THEN {name}
        WHEN x.kind = 'ipv6' THEN if(x.m rlike '[A-F]', upper({eight}), {eight}) WHEN x.kind = 'mac' and x.m rlike '[A-F]' THEN upper({full}) ELSE {full} END"""


def surrogates(entities: str, key: str, dressed: bool = False) -> Column:
    """What replaces each of an array of structs ``m, kind, canon, n``.

    The canonical form, or the mention's own; one step a field, so that each is
    worked out once an entity.
    """
    drawn = f"transform({entities}, x -> named_struct('m', x.m, 'kind', x.kind, 'canon', x.canon, 'n', x.n, 's', {_stream(key)}))"
    faked = f"transform({drawn}, x -> named_struct('m', x.m, 'kind', x.kind, 'fake', {_surrogate()}))"
    return F.expr(f"transform({faked}, x -> {_dressed() if dressed else 'x.fake'})")


#: What entities have: a digit or @, a title (tried only at characters that begin
#: one), a quote after = or :, or what stands inside addresses made of letters.
_GATE = r"(?=[0-9@DFHMPSГгκΚ=:-])(?:[0-9@]|M(?:r|s|me|iss|ister|adame|onsieur)|Herr|Frau|S(?:r|eñor)|Dr|Prof|[Гг]оспо|[κΚ]υρία|[κΚ]ύριος|[=:]\s{0,3}[\"']|:[:A-Fa-f]|-[A-Fa-f]{2}-)"
#: Beginnings of keys that may be made of letters alone.
_KEYS = ["AKIA", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-", "eyJ"]


def may_hold(text: Column) -> Column:
    """False for a text that holds no entity: scans for what every pattern has."""
    found = text.rlike(_GATE)
    for k in _KEYS:
        found = found | text.contains(k)
    return found


def _and_names(persons: Column) -> Column:
    """``PATTERN`` and the words of a text's own names, longest first."""
    words = F.array_distinct(F.transform(persons, lambda p: p.m))
    listed = F.array_sort(words, lambda a, b: F.when(F.length(a) != F.length(b), F.length(b) - F.length(a)).when(a < b, -1).when(a > b, 1).otherwise(0))
    return F.concat(F.lit(rf"{PATTERN}|(?<![\p{{L}}\p{{N}}])(?=\p{{Lu}})(?:"), F.array_join(listed, "|"), F.lit(r")(?![\p{L}\p{N}])"))


def typed(found: Column, persons: Column | None = None) -> Column:
    """An array of mentions as structs ``m, kind, canon``; kind is null for what is none."""
    if persons is None:
        kinds = F.transform(found, lambda m: F.struct(m.alias("m"), kind_of(m).alias("kind")))
        return F.transform(kinds, lambda x: x.withField("canon", canonical(x.kind, x.m)))
    own = F.transform(found, lambda m: F.struct(m.alias("m"), F.get(F.filter(persons, lambda p: p.m == m), 0).alias("p")))
    kinds = F.transform(own, lambda x: F.struct(x.m.alias("m"), F.when(x.p.isNotNull(), x.p.kind).otherwise(kind_of(x.m)).alias("kind"), x.p.canon.alias("c")))
    return F.transform(kinds, lambda x: F.struct(x.m.alias("m"), x.kind.alias("kind"), F.coalesce(x.c, canonical(x.kind, x.m)).alias("canon")))


def found_in(docs: DataFrame, text: Column, names: tuple[str, str]) -> DataFrame:
    """``docs`` with the persons of each text and all its mentions, in order.

    Both are null for a text that cannot hold an entity.
    """
    persons, mentions = names
    with_persons = docs.withColumn(persons, F.when(may_hold(text), people(text)))
    p = F.col(persons)
    plain = typed(F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)))
    named = typed(F.regexp_extract_all(text, _and_names(p), F.lit(0)), p)
    return with_persons.withColumn(mentions, F.when(F.size(p) > 0, named).when(p.isNotNull(), plain))


def distinct_entities(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``kind, canon``, each distinct entity of the corpus once."""
    found = found_in(docs.select(F.col(f"`{text_col}`").cast("string").alias("text")), F.col("text"), ("persons", "mentions"))
    # an inner explode would have the search done twice, once more in a filter that Spark infers
    return found.select(F.explode_outer("mentions").alias("e")).where("e.kind is not null").select("e.kind", "e.canon").distinct()


def exceptions(entities: DataFrame, key: str) -> DataFrame | None:
    """``kind, canon, attempt`` of entities whose first surrogate is taken.

    Of entities that draw one surrogate the smallest keeps it, and none may
    draw a real entity. None when all first draws differ, the usual case. Each
    attempt's space is larger than the one before it, so the rounds end.
    """
    c = F.col("canon")
    real = entities.select("kind", c.alias("fake"))
    open_ = entities
    settled: DataFrame | None = None
    for attempt in itertools.count():
        one = surrogates(f"array(named_struct('m', canon, 'kind', kind, 'canon', canon, 'n', {attempt}))", key)
        drawn = written(open_.select("kind", "canon", one[0].alias("fake")), "pii-drawn")
        # one pass over draws, real entities and what earlier rounds gave out
        held = real.select("kind", "fake", F.lit(None).cast("string").alias("canon"))
        if settled is not None:
            held = held.union(settled.select("kind", "fake", F.lit(None).cast("string")))
        first = drawn.select("kind", "fake", "canon").union(held).groupBy("kind", "fake").agg(F.min("canon").alias("winner"), F.count_if(c.isNull()).alias("taken"), F.count("canon").alias("n"))
        clash = written(first.where("n > 0 and (taken > 0 or n > 1)").withColumn("winner", F.when(F.col("taken") == 0, F.col("winner"))), "pii-clash")
        if clash.isEmpty():
            losers = None
        else:
            losers = written(drawn.join(clash.select("kind", "fake", "winner"), ["kind", "fake"]).where(~F.col("winner").eqNullSafe(c)).select("kind", "canon"), "pii-losers")
        if attempt == 0:
            if losers is None:
                return None
            settled = written(drawn.join(losers, ["kind", "canon"], "left_anti").select("kind", "canon", "fake", F.lit(0).alias("attempt")), "pii-settled")
        else:
            won = drawn if losers is None else drawn.join(losers, ["kind", "canon"], "left_anti")
            settled = written(settled.union(won.select("kind", "canon", "fake", F.lit(attempt))), "pii-settled")
            if losers is None:
                return settled.where("attempt > 0").select("kind", "canon", "attempt")
        open_ = losers


def replace_personal_data(docs: DataFrame, key: str, text_col: str = "text", map_rows: int = MAP_ROWS) -> DataFrame:
    """``docs`` with every entity replaced; ``n_replaced`` counts mentions."""
    entities = written(distinct_entities(docs, text_col), "pii-entities")
    moved = exceptions(entities, key)
    names = [c for c in docs.columns if c != "n_replaced"]
    persons, mentions, pieces, row, held = (fresh(c, docs.columns) for c in ("persons", "mentions", "pieces", "row", "moved"))
    rows = docs.select(*[F.col(f"`{c}`") for c in names])
    tag = lambda kind, canon: F.concat_ws("\x1e", kind, canon)
    text = F.col(f"`{text_col}`")
    if moved is None:
        attempt_of = lambda kind, canon: F.lit(0)
    elif moved.count() <= map_rows:
        table = {f"{r['kind']}\x1e{r['canon']}": r["attempt"] for r in moved.collect()}
        inside = F.from_json(F.lit(json.dumps(table)), "map<string,int>")
        attempt_of = lambda kind, canon: F.coalesce(F.try_element_at(inside, tag(kind, canon)), F.lit(0))
    else:
        rows = written(rows.withColumn(row, F.monotonically_increasing_id()), "pii-rows")
        said = found_in(rows, text, (persons, mentions)).select(F.col(row).alias("row"), F.explode_outer(mentions).alias("e")).where("e.kind is not null").select("row", "e.kind", "e.canon").distinct()
        of = said.join(moved, ["kind", "canon"]).groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct(tag(F.col("kind"), F.col("canon")), "attempt"))).alias(held))
        rows = rows.join(of.withColumnRenamed("row", row), row, "left")
        attempt_of = lambda kind, canon: F.coalesce(F.try_element_at(F.col(held), tag(kind, canon)), F.lit(0))

    found = found_in(rows, text, (persons, mentions))
    found = found.withColumn(mentions, F.transform(mentions, lambda x: F.struct(x.m.alias("m"), x.kind.alias("kind"), x.canon.alias("canon"), attempt_of(x.kind, x.canon).alias("n"))))
    swapped = surrogates(f"`{mentions}`", key, dressed=True)
    gaps = F.when(F.size(persons) > 0, F.split(text, _and_names(F.col(persons)), -1)).otherwise(F.split(text, PATTERN, -1))
    some = F.exists(mentions, lambda x: x.kind.isNotNull())
    glued = F.array_join(F.flatten(F.zip_with(gaps, swapped, lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "")
    new = found.withColumn(pieces, F.when(some, glued).otherwise(text))
    out = []
    for c in names:
        if c == text_col:
            out.append(F.col(pieces).alias(c))
        elif c == "n_chars":
            out.append(F.when(some, F.length(pieces).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    count = F.size(F.filter(mentions, lambda x: x.kind.isNotNull()))
    return new.select(*out, F.when(some, count).otherwise(0).cast("long").alias("n_replaced"))


def session_key(spark) -> str:
    """The key in ``spark.threadloom.pii.key``; where unset, one is drawn for the session.

    Calls in one session so agree on every surrogate; sessions do only by a key that is set.
    """
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        key = secrets.token_hex(32)
        spark.conf.set(KEY_SETTING, key)
    return key


def op1_query(spark, sf_dir: str) -> DataFrame:
    return replace_personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet"), session_key(spark))
