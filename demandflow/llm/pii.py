"""PII: surrogate generation.  Detected entities get keyed replacements of the same type and
format, the same one everywhere, and never one that another entity has.

A mention is matched by one regular expression (e-mail, phone, IPv4 address, US social security
number, payment card, key or token, titled personal name).  Its *entity* is the canonical form:
digits without punctuation for cards, numbers without the country code for phones, lower case
for e-mails and names.  The surrogate of an entity is derived from SHA-256 of a secret key, its
type, its canonical form and an attempt number:

* letters become letters, digits digits; a card keeps its first digit and, if its check digit
  was right, gets a right one; an IPv4 address gets octets 1 to 254; an e-mail's host ends in a
  reserved example domain;
* a given name gets one of the same gender (by its title) and script, a surname one of the same
  script; both are built from syllables, so there are enough of them;
* each mention is rewritten in its own format: punctuation, country code, title, case.

*Coreference*: the surrogate depends on the entity alone, so all its mentions agree across the
corpus.  *Distinctness*: over all distinct entities of the corpus, a surrogate that two
entities share, or that is itself an entity of the corpus, is drawn again with the next attempt
until none is left.

All steps are Spark expressions, joins and aggregations.  Only texts with a mention are
shuffled, and entities are reduced to distinct ones first, so an entity or a text that a third
of all rows hold costs one row per task; the join that attaches surrogates to rows streams the
rows and can be split where a key is hot.

Null texts stay null and texts without a mention are returned unchanged.  Repeated rows stay
repeated, ties between entities are broken by their canonical form, empty tables give empty
results, and other columns, whatever their names, are returned as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandflow.llm.common import Scratch

FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа")
NEUTRAL = ("Dr", "Prof", "Professor", "Doctor")
MALE = ("Mr", "Herr", "Monsieur", "Señor", "Господин")
_LATIN = ("ba", "ce", "di", "fo", "ga", "he", "ji", "ko", "la", "me", "ni", "po", "ra", "se", "ti", "vo")
#: Lower-case letters (or signs) that stand for those of a script.
LETTERS = {
    "Cyrillic": "абвгдежзиклмнопрстуфхцчшэюя", "Greek": "αβγδεζηθικλμνξοπρστυφχψω", "Armenian": "աբգդեզլկմնոպսվտր",
    "Hebrew": "אבגדהוזחטכלמנסעפצקרשת", "Arabic": "ابتثجحدرزسشصضطعغفقكلمنهوي", "Devanagari": "कखगघचछजटडतदनपबमयरलवसह",
    "Thai": "กขคงจชซดตถทนบปผพมยรลวสหอ", "Hiragana": "あいうえおかきくけこさしすせそたちつてとなにぬねの",
    "Katakana": "アイウエオカキクケコサシスセソタチツテトナニヌネノ", "Hangul": "가나다라마바사아자차카타파하고노도로모보소오조호",
    "Han": "一人口日月木水火山石田土金心手目耳車門雨",
}
_CASED = ("Greek", "Armenian")  # of names, beside Latin and Cyrillic, which have syllables
_CYRILLIC = ("ба", "ве", "ги", "до", "жа", "зе", "ки", "ло", "ма", "не", "пи", "ро", "са", "те", "фи", "хо")

_TITLES = "|".join(sorted(FEMALE + MALE + NEUTRAL, key=lambda t: (-len(t), t)))
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_RUN = r"[\p{L}\p{M}\p{N}._+-]"
_LABEL = r"[\p{L}\p{M}\p{N}-]"
_NAME = r"\p{Lu}(?:[\p{L}\p{M}]++|(?=[\x27’-]\p{L}))(?:(?:[\x27’]\p{Lu}|-\p{L})[\p{L}\p{M}]*+)*+"
#: An e-mail is the whole run before its '@' (leading dots and dashes are no part of the entity) and starts
#: where a run or the rest after the last match starts.
_EMAIL = (rf"(?:\G|(?<!{_RUN}))[.-]*+{_RUN}++@(?:{_LABEL}{{1,63}}\.){{1,126}}"
          r"(?:[Xx][Nn]--[A-Za-z0-9-]{2,59}|[A-Za-z]{2,24}|[\p{L}\p{M}]{2,24}+)(?![A-Za-z0-9])")
#: One alternative per type, none of which starts inside a word.  A run is entered only at its start
#: and left possessively, or its length is bounded, so long unbroken texts take linear time.
MENTION = rf"(?:{_EMAIL}|(?<![A-Za-z0-9])(?:" + "|".join((
    rf"(?<![0-9])(?<![0-9]\.)(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])",
    r"(?<![0-9A-Za-z+])\+[0-9]{1,3}[ .-]?\(?[0-9]{2,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])",
    r"(?<![0-9A-Za-z(])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])",
    r"(?<![0-9A-Za-z.-])[0-9]{3}([.-])[0-9]{3}\1[0-9]{4}(?![0-9-]|\.[0-9])",
    r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+|AKIA[0-9A-Z]{16}|(?:sk|pk|ghp)_[A-Za-z0-9_]{16,}+)(?![0-9A-Za-z])",
    r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
    rf"(?=[DPMHFSГ])(?<!\p{{L}})(?:{_TITLES})\.? {_NAME}(?: {_NAME})?+(?!\p{{L}})",
)) + "))"


def _quoted(s: str) -> str:
    return "r'" + s.replace("'", "\\'") + "'"


_RX = _quoted(MENTION)
_MENTIONS = f"regexp_extract_all(text, {_RX}, 0)"


def _digits(m: str) -> str:
    return f"regexp_replace({m}, '[^0-9]', '')"


def _kind(m: str) -> str:
    return f"""case when contains({m}, '@') then 'email'
        when {m} rlike r'^\\p{{L}}+[.]? \\p{{Lu}}' then 'name'
        when {m} rlike '^([0-9]{{1,3}}[.]){{3}}[0-9]{{1,3}}$' then 'ip'
        when {m} rlike '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$' then 'ssn'
        when {m} rlike '^[+(]|^[0-9]{{3}}[.-][0-9]{{3}}[.-]' then 'phone'
        when {m} rlike '^[0-9]([ -]?[0-9]){{12,18}}$' then 'card' else 'secret' end"""


def _canon(m: str) -> str:
    """Canonical form of everything but names."""
    return f"""case {_kind(m)} when 'email' then lower(regexp_replace({m}, '^[.-]+', '')) when 'phone' then right({_digits(m)}, 10)
        when 'card' then {_digits(m)} else {m} end"""


def _script(m: str) -> str:
    others = " ".join(f"when split({m}, ' ', 2)[1] rlike r'\\p{{Is{s}}}' then '{s.lower()}'" for s in _CASED)
    return f"case when {m} rlike r'\\p{{IsCyrillic}}' then 'cyrillic' {others} else 'latin' end"


def _gender(m: str) -> str:
    title = f"replace(split({m}, ' ')[0], '.', '')"
    return f"case when {title} in ({', '.join(map(repr, FEMALE))}) then 'f' when {title} in ({', '.join(map(repr, NEUTRAL))}) then 'n' else 'm' end"


def _given(m: str) -> str:
    return f"concat('given:', {_gender(m)}, ':', {_script(m)}, '|', translate(lower(split({m}, ' ')[1]), '’', chr(39)))"


def _surname(m: str) -> str:
    return f"concat('surname:', {_script(m)}, '|', translate(lower(element_at(split({m}, ' '), -1)), '’', chr(39)))"


def _entities(m: str) -> str:
    """Entities of a mention as ``type|canonical form``: one, or two for a full name."""
    return f"""case when {_kind(m)} <> 'name' then array(concat({_kind(m)}, '|', {_canon(m)}))
        when size(split({m}, ' ')) = 3 then array({_given(m)}, {_surname(m)}) else array({_surname(m)}) end"""


def _filled(m: str, digits: str) -> str:
    """A mention with its digits replaced in order."""
    return f"""aggregate(split({m}, ''), named_struct('i', 1, 'o', ''), (a, c) -> if(c rlike '[0-9]',
        named_struct('i', a.i + 1, 'o', concat(a.o, substr({digits}, a.i, 1))), named_struct('i', a.i, 'o', concat(a.o, c))), a -> a.o)"""


def _rewritten(m: str, found: str) -> str:
    """The surrogate of a mention in the mention's own format; ``found`` maps entities."""
    new = f"element_at({found}, concat({_kind(m)}, '|', {_canon(m)}))"
    kept = f"left({_digits(m)}, greatest(char_length({_digits(m)}) - 10, 0))"

    def cased(word: str, entity: str) -> str:
        return f"if({word} = upper({word}), upper(element_at({found}, {entity})), initcap(element_at({found}, {entity})))"

    return f"""case {_kind(m)} when 'name' then concat_ws(' ', split({m}, ' ')[0],
            if(size(split({m}, ' ')) = 3, {cased(f"split({m}, ' ')[1]", _given(m))}, null), {cased(f"element_at(split({m}, ' '), -1)", _surname(m))})
        when 'phone' then {_filled(m, f"concat({kept}, {new})")} when 'card' then {_filled(m, new)}
        when 'email' then concat(regexp_extract({m}, '^[.-]*', 0), if({m} = upper({m}), upper({new}), {new})) else {new} end"""


def _luhn(digits: str) -> str:
    """Sum over digits from the right, the rightmost doubled (for all but the check digit)."""
    d = f"cast(substr(reverse({digits}), i, 1) as int)"
    return f"aggregate(sequence(1, char_length({digits})), 0, (a, i) -> a + if(i % 2 = 1, if({d} > 4, 2 * {d} - 9, 2 * {d}), {d}))"


def _check_digit(body: str) -> str:
    return f"cast((10 - {_luhn(body)} % 10) % 10 as string)"


def surrogate(key: str) -> dict[str, str]:
    """SQL steps over ``type, canon, attempt`` that end in ``surrogate``.  ``h`` holds 64 bytes of
    the keyed hash as hex; the i-th character of an entity is drawn from its i-th byte."""
    seed = f"concat_ws('|', {_quoted(key)}, type, canon, cast(attempt as string)"
    byte = "cast(conv(substr(h, 2 * ((i % 64) + 1) - 1, 2), 16, 10) as int)"

    def drawn(s: str, hexes: bool = False, byte: str = byte) -> str:
        digit = f"substr('0123456789abcdef', {byte} % 16 + 1, 1)" if hexes else f"cast({byte} % 10 as string)"
        lower = digit if hexes else f"substr('abcdefghijklmnopqrstuvwxyz', {byte} % 26 + 1, 1)"
        # a letter of another script is drawn from its own, in its own case
        own = "" if hexes else " ".join(
            f"when c rlike r'\\p{{Is{s}}}' then if(c = lower(c), substr('{x}', {byte} % {len(x)} + 1, 1), upper(substr('{x}', {byte} % {len(x)} + 1, 1)))"
            for s, x in LETTERS.items())
        return f"""array_join(transform(split({s}, ''), (c, i) -> case when c rlike '[0-9]' then {digit} when c rlike '[a-z]' then {lower}
            when c rlike '[A-Z]' then upper({lower}) when c rlike r'\\p{{N}}' then {digit} {own} when c rlike r'[\\p{{L}}\\p{{M}}]' then {lower}
            else c end), '')"""

    def name(syllables: tuple[str, ...], ends: tuple[str, ...]) -> str:
        # three syllables, one more with every attempt
        pick = f"element_at(array({', '.join(repr(s) for s in syllables)}), {byte} % {len(syllables)} + 1)"
        end = f"element_at(array({', '.join(repr(s) for s in ends)}), (cast(conv(substr(h, 127, 2), 16, 10) as int)) % {len(ends)} + 1)"
        return f"concat(array_join(transform(sequence(0, 2 + attempt), i -> {pick}), ''), {end})"

    local, host = "substring_index(canon, '@', 1)", "substring_index(canon, '@', -1)"
    labels = f"split({host}, '[.]')"
    inner = f"array_join(slice({labels}, 1, greatest(size({labels}) - 2, 0)), '.')"
    tail = "concat('example.', element_at(array('com', 'net', 'org'), cast(conv(substr(h, 127, 2), 16, 10) as int) % 3 + 1))"
    # short names soon run out: later attempts add 4, 8, 16 and 32 digits
    more = f"sha2({seed}, '3'), 256)"
    extra = f"""if(attempt > 1, array_join(transform(sequence(0, shiftleft(1, least(attempt, 5)) - 1),
        i -> cast(conv(substr({more}, 2 * i + 1, 2), 16, 10) as int) % 10), ''), '')"""
    other = byte.replace("(h,", "(reverse(h),")
    email = f"concat({drawn(local)}, {extra}, '@', if(size({labels}) > 2, concat({drawn(inner, byte=other)}, '.'), ''), {tail})"
    alike = " ".join(f"when type like 'given:%:{s.lower()}' or type = 'surname:{s.lower()}' then {name(tuple(LETTERS[s]), tuple(LETTERS[s][:4]))}"
                     for s in _CASED)
    octets = ", ".join(f"cast(cast(conv(substr(h, {8 * k + 1}, 6), 16, 10) as int) % 254 + 1 as string)" for k in range(4))
    card = "concat(left(canon, 1), substr(d, 2, char_length(d) - 2))"
    valid = f"right(canon, 1) = {_check_digit('left(canon, char_length(canon) - 1)')}"
    return {
        "h": f"concat(sha2({seed}, '1'), 256), sha2({seed}, '2'), 256))",
        "d": f"if(type in ('card', 'phone', 'ssn'), {drawn('canon')}, null)",
        "surrogate": f"""case type when 'email' then {email} when 'ip' then concat_ws('.', {octets})
            when 'phone' then concat(cast(2 + cast(left(d, 1) as int) % 8 as string), substr(d, 2)) when 'ssn' then d
            when 'card' then concat({card}, if({valid}, {_check_digit(card)}, right(d, 1)))
            when 'secret' then if(canon rlike '^([0-9a-f]+|[0-9A-F]+)$', {drawn('canon', True)}, concat(left(canon, 4), {drawn('substr(canon, 5)')}))
            when 'given:f:latin' then {name(_LATIN, ('na', 'lia', 'ra', 'sa'))} when 'given:m:latin' then {name(_LATIN, ('n', 'rt', 's', 'ld'))}
            when 'given:n:latin' then {name(_LATIN, ('n', 'ra', 's', 'lia'))} when 'given:n:cyrillic' then {name(_CYRILLIC, ('н', 'ра', 'с', 'лия'))}
            when 'given:f:cyrillic' then {name(_CYRILLIC, ('на', 'лия', 'ра', 'са'))} when 'given:m:cyrillic' then {name(_CYRILLIC, ('н', 'рт', 'с', 'льд'))}
            when 'surname:cyrillic' then {name(_CYRILLIC, ('к', 'ц', 'нь', 'р'))} else case {alike} else {name(_LATIN, ('ck', 'll', 'nd', 'r'))} end end""",
    }


def _with_surrogate(entities: DataFrame, key: str) -> DataFrame:
    for column, sql in surrogate(key).items():
        entities = entities.withColumn(column, F.expr(sql))
    return entities.select("type", "canon", "attempt", "surrogate")


def surrogates(entities: DataFrame, scratch: Scratch, key: str) -> DataFrame:
    """``type, canon, surrogate`` of distinct entities ``type, canon``: one to one within a type,
    and none is itself an entity.  E-mails and names have more surrogates with every attempt, so a few
    rounds are enough.  A type of fixed length fails if its clashes stay as many for 50 rounds,
    because its format has too few values."""
    now = scratch.write(_with_surrogate(entities.withColumn("attempt", F.lit(0)), key), "surrogates")
    fewest, stale = None, 0
    while True:
        # of those that share a surrogate, the one with the fewest attempts keeps it
        first = now.groupBy("type", "surrogate").agg(F.count(F.lit(1)).alias("sharing"), F.min(F.struct("attempt", "canon")).alias("owner"))
        taken = now.select("type", F.col("canon").alias("surrogate"), F.lit(True).alias("is_entity"))
        clash = first.join(taken, ["type", "surrogate"], "left").where("sharing > 1 OR is_entity")
        again = now.join(clash, ["type", "surrogate"]).where("is_entity OR struct(attempt, canon) <> owner").select("type", "canon")
        again = scratch.write(again, "clashes")
        left = again.count()
        if not left:
            return now.select("type", "canon", "surrogate")
        fewest, stale = (left, 0) if fewest is None or left < fewest else (fewest, stale + 1)
        if stale == 50:
            raise RuntimeError(f"no free surrogates of the same format for {left} entities")
        marked = now.join(again.withColumn("clash", F.lit(1)), ["type", "canon"], "left")
        marked = marked.select("type", "canon", (F.col("attempt") + F.coalesce("clash", F.lit(0))).alias("attempt"))
        before, now = now, scratch.write(_with_surrogate(marked, key), "surrogates")
        scratch.drop(before, again)


def replace(docs: DataFrame, scratch: Scratch, key: str) -> DataFrame:
    """``docs`` with its mentions rewritten in ``text``, and ``n_entities`` (mentions in the text).
    ``key`` is the secret; without it surrogates can't be linked to entities."""
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").cast("string").alias("text"))
    # the first match decides whether a text has any; only those that do are searched through
    have = row.where(F.expr(f"text RLIKE {_RX}")).withColumn("mentions", F.expr(_MENTIONS)).withColumn("k", F.md5("text"))
    none = F.expr("cast(array() as array<string>)").alias("mentions")
    held = have.select("k", F.explode(F.expr(f"flatten(transform(array_distinct(mentions), m -> {_entities('m')}))")).alias("e")).distinct()
    held = scratch.write(held.select("k", F.substring_index("e", "|", 1).alias("type"), F.expr("substr(e, instr(e, '|') + 1)").alias("canon")), "held")
    named = surrogates(held.select("type", "canon").distinct(), scratch, key)
    maps = held.join(named, ["type", "canon"]).groupBy("k").agg(
        F.map_from_entries(F.collect_list(F.struct(F.concat_ws("|", "type", "canon"), "surrogate"))).alias("found"))
    changed = have.join(maps, "k").withColumn("text", F.expr(
        f"array_join(zip_with(split(text, {_RX}, -1), transform(mentions, m -> {_rewritten('m', 'found')}), (p, r) -> concat(p, coalesce(r, ''))), '')"))
    same = row.where(F.expr(f"text IS NULL OR NOT text RLIKE {_RX}")).select("*", none)

    def out(df: DataFrame) -> DataFrame:
        columns: list[Column] = [F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns]
        return df.select(*columns, F.size("mentions").cast("long").alias("n_entities"))

    return out(changed).unionByName(out(same)) if "n_entities" not in docs.columns else out(changed).union(out(same))
