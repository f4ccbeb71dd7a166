"""Personal data replaced by keyed surrogates of the same kind, gender, script and format.

1. One pattern finds all entities of a text: e-mail addresses, card, account (IBAN) and phone numbers,
   social security numbers, IPv4 and IPv6 addresses, secrets (keys, tokens, passwords) and names after a
   title.
2. An entity's canonical form is what its spellings share (an address in lower case, a number's digits, a
   single name in lower case), so each mention of it gets the same surrogate, in whatever format it
   is written there. "Mr. John Smith" and "Mr. Smith" share the surrogate of Smith.
3. A surrogate is drawn from a SHA-256 of the key, kind, form and attempt: digits for digits, letters for
   letters, octets for octets, eight groups for an IPv6 address, and for names syllables of the script with the ending of the gender.
4. Surrogates that two forms share, or that occur as an original anywhere in the corpus, are drawn again
   with the next attempt until none is left. Each attempt widens the choice of addresses, secrets and
   names; numbers keep their format for ATTEMPTS attempts and then get longer, so every form is settled.
   So different entities stay different, and no surrogate points at another person of the corpus.
5. Texts are split by the same pattern and joined again with the surrogates in between.

Everything is DataFrame code. The distinct forms are combined before the shuffle; mentions meet their
surrogates in a sort-merge join on a stored table, so a form that a third of the texts mention is split
by adaptive execution. Mentions are gathered by text only. Whole texts are shuffled once.

Defined cases: a null text stays null and has no entity; an empty text stays empty. Rows that repeat an id
and text get equal results, rows that share an id are told apart by a hash of the text, and a null id is
an id like others. Texts and entities of any length are whole, in time that grows with their length; a text's
entities are gathered in one row. Of forms that draw the same surrogate the first by attempt, kind, form,
gender and script keeps it. An empty table gives an empty result. Other columns are not looked at. A masked secret
("password: ********", signs of MASK alone) is no entity and stays; a secret of other signs without a
letter or digit gets a letter for each sign.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.scratch import release, store

#: Titles by gender; the name after one is personal data.
TITLES = {
    "male": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин", "Κύριος"],
    "female": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа", "Κυρία"],
    "": ["Dr", "Prof"],
}

NAME = r"\p{Lu}[\p{L}'’-]+"

#: Signs that stand in the place of a secret, and what may follow them.
MASK = r"[*•●∙·.…_#~=<>-]+[,;:!?)}'’\]]*"

#: What secrets begin with; it is kept.
BEGIN = r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----"
BARE = r"\b(?:gh[pousr]_|github_pat_|glpat-|sk-|[sr]k_(?:live|test)_|xox[abeprs]-|AIza|eyJ)"
NAMED = r"(?i:\b(?:password|passwd|token|secret|api_?key)\s*[=:]\s*)"

#: A group of an IPv6 address.
H = r"[0-9A-Fa-f]{1,4}"

#: Kinds and their patterns, in the order in which they are tried at a place. Java's engine recurses for each
#: round of a group repeated without a bound, unless the repeat is possessive, and a run without a left
#: boundary is scanned again from each of its signs; so repeats without a bound are of one class, or possessive,
#: and begin where a run begins or where the last entity ended.
PATTERNS = {
    "secret": r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b|" + NAMED + r"\"?(?!" + MASK + r"(?:[\s\"]|\z))[^\s\"]{6,}\"?"
    + "|" + BARE + r"[A-Za-z0-9_-]{16,}(?:\.[A-Za-z0-9_-]+){0,2}"
    + "|" + BEGIN + r"(?:[^-]++|-(?!----))++",
    "email": r"(?:\G|(?<![\p{L}\p{N}._%+-]))[._%+-]*+[\p{L}\p{N}][\p{L}\p{N}._%+-]*+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d.]*\d)",
    # the short form with three colons at least, or of a local range: not '1::2' or 'a::b' of programs
    "ipv6": r"(?<![\w:.])(?=[A-Fa-f:]*\d)(?:" + f"(?:{H}:){{7}}{H}|(?=(?:[0-9A-Fa-f]*:){{3}}|[Ff][CcDdEe][0-9A-Fa-f]{{2}}:)"
    + f"(?:{H}:){{1,6}}(?::{H}){{1,6}}" + r")(?![\w:])",
    "iban": r"\b[A-Z]{2}\d{2}(?:(?=[A-Z0-9]*\d{5})[A-Z0-9]{11,30}|"
    r" [A-Z0-9]{4}(?: (?=[A-Z]*\d)[A-Z0-9]{4}){1,6}(?: (?=[A-Z]*\d)[A-Z0-9]{1,3})?)\b",
    # 16 digits, 15 of American Express, 14 of Diners, 19 that begin with 6
    "card": r"(?<!\d)(?:6\d{3}(?:[ -]?\d{4}){3}[ -]?\d{3}|\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{4}"
    r"|3[47]\d{2}[ -]?\d{6}[ -]?\d{5}|3[068]\d{2}[ -]?\d{6}[ -]?\d{4})(?!\d)",
    # with country code; with an area code in brackets; with a trunk zero and a gap; three, three and four
    "phone": r"\+\d{1,3}[ .-]?\(?\d{2,4}\)?[ .-]?\d{3}[ .-]?\d{3,4}(?!\d)"
    r"|(?:\+|(?<![\w.,+-])00)[1-9]\d{0,2}(?:[ .-]?\(0\))?(?=(?:[ ./()-]{0,2}\d){7,12}(?!\d))(?:[ ./-]?\(?\d{1,8}\)?){1,6}(?!\d)"
    r"|\(\d{2,5}\)[ .-]?\d{3,4}(?:[ .-]?\d{2,4}){1,2}(?!\d)"
    r"|(?<![\w.,+-])0[1-9]\d{1,4}[ /-](?=(?:[ -]?\d){5,9}(?!\d))\d{2,8}(?:[ -]?\d{2,8}){0,3}(?!\d)"
    r"|(?<![\w.,+-])(?:1[ .-])?[2-9]\d{2}[ .-]\d{3}[ .-]\d{4}(?![\w-])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "name": r"\b(?:" + "|".join(t for ts in TITLES.values() for t in ts) + r")\b\.? " + NAME + r"(?: " + NAME + r")?",
}

#: No groups that capture: they would mean different things to finding and to splitting.
PATTERN = "|".join(PATTERNS.values())

#: Syllables of surrogate names by script, 16 each, and endings by gender.
SYLLABLES = {
    "latin": "ba be bo da de di ka ko la le ma mi na ro sa ti",
    "cyrillic": "ба бе бо да де ди ка ко ла ле ма ми на ро са ти",
    "greek": "βα βε βο δα δε δι κα κο λα λε μα μι να ρο σα τι",
}
ENDINGS = {
    "latin": {"male": "n", "female": "a", "": "s"},
    "cyrillic": {"male": "н", "female": "а", "": "с"},
    "greek": {"male": "ς", "female": "α", "": "ν"},
}

#: Attempts after which numbers no longer keep their length, and addresses of four octets their range.
ATTEMPTS = 20


def kind_of(value: Column) -> Column:
    """Which pattern a found value matches as a whole, the first of several."""
    found = F.lit("name")
    for kind, pattern in reversed(list(PATTERNS.items())):
        if kind != "name":
            found = F.when(F.regexp_like(value, F.lit(f"^(?:{pattern})$")), kind).otherwise(found)
    return found


def mentions(texts: DataFrame) -> DataFrame:
    """A row per entity, and for names one per part: id, hash, place, part, value, kind, form, gender.

    `head` is what stands before the part and is kept: a title, a key's name, a country code."""
    found = texts.select(
        "id", "hash", F.posexplode(F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))).alias("place", "whole")
    ).distinct()
    found = found.withColumn("kind", kind_of(F.col("whole")))
    title = F.regexp_extract("whole", r"^([\p{L}]+)\.? ", 1)
    gender = F.when(title.isin(TITLES["male"]), "male").when(title.isin(TITLES["female"]), "female").otherwise("")
    head = (
        F.when(F.col("kind") == "name", F.regexp_extract("whole", r"^([\p{L}]+\.?) ", 1))
        .when(F.col("kind") == "phone", F.regexp_extract("whole", r"^((?:\+|00)\d{1,3}(?=[^\d])|\+\d|00\d)", 1))
        .when(F.col("kind") == "secret", F.regexp_extract("whole", f"^({BEGIN}|AKIA|ASIA|{BARE}|{NAMED})", 1))
        .when(F.col("kind") == "email", F.regexp_extract("whole", r"^([._%+-]*)", 1))
        .when(F.col("kind") == "iban", F.substring("whole", 1, 2))
        .otherwise("")
    )
    rest = F.expr("substring(whole, char_length(head) + 1)")
    parts = F.when(F.col("kind") == "name", F.split(F.trim("rest"), " ")).otherwise(F.array("rest"))
    split = (
        found.withColumn("gender", F.when(F.col("kind") == "name", gender).otherwise(""))
        .withColumn("head", head)
        .withColumn("rest", rest)
        .select("id", "hash", "place", "kind", "gender", "head", F.size(parts).alias("parts"), F.posexplode(parts).alias("part", "value"))
    )
    # only a given name shows a gender; the last part is the family name
    given = (F.col("kind") == "name") & (F.col("part") < F.col("parts") - 1)
    form = (
        F.when(F.col("kind").isin("card", "phone", "ssn"), F.regexp_replace("value", r"[^0-9]", ""))
        .when(F.col("kind") == "iban", F.regexp_replace("value", " ", ""))
        .when(F.col("kind") == "secret", F.regexp_replace("value", '"', ""))
        .otherwise(F.lower("value"))
    )
    script = (
        F.when(F.regexp_like("value", F.lit(r"\p{IsCyrillic}")), "cyrillic")
        .when(F.regexp_like("value", F.lit(r"\p{IsGreek}")), "greek")
        .otherwise("latin")
    )
    return split.withColumns(
        {
            "gender": F.when(given, F.col("gender")).otherwise(""),
            "kind": F.when(F.col("kind") == "name", F.when(given, "given").otherwise("family")).otherwise(F.col("kind")),
            "form": form,
            "script": F.when(F.col("kind") == "name", script).otherwise(""),
        }
    )


def drawn(key: str) -> dict[str, Column]:
    """The surrogate form of (kind, form, gender, script, attempt)."""
    parts = F.concat_ws("\x1f", F.lit(key), "kind", "form", "gender", "script", F.col("attempt").cast("string"))
    hex_ = F.concat(F.sha2(parts, 256), F.sha2(F.concat(F.lit("+"), parts), 256))
    digits = F.translate(hex_, "abcdef", "012345")
    letters = F.translate(hex_, "0123456789", "ghijkmnpqr")
    # each sign by one of its class, and by letters where there is no letter or digit; beyond 128 signs the
    # stream starts anew
    walk = """array_join(transform(split(form, ''), (c, i) ->
        CASE WHEN c RLIKE '\\\\p{N}' THEN substring(digits, i % 128 + 1, 1)
             WHEN c RLIKE '\\\\p{Lu}' THEN upper(substring(letters, i % 128 + 1, 1))
             WHEN c RLIKE '\\\\p{L}' OR signs THEN substring(letters, i % 128 + 1, 1)
             ELSE c END), '')"""
    # addresses and secrets grow by letters when their own length leaves too little choice, an address
    # keeps its last label
    wider = "repeat(substring(letters, 100, 1 + attempt), least(attempt, 1))"
    email = f"""concat({wider}, substring({walk}, 1, char_length(form) - char_length(substring_index(form, '.', -1))),
                substring_index(form, '.', -1))"""
    secret = f"concat({wider}, {walk})"
    longer = f"concat({walk}, substring(digits, 100, greatest(attempt - {ATTEMPTS}, 0)))"
    octet = lambda i: f"cast(conv(substring(hex, {2 * i + 1}, 2), 16, 10) AS int)"
    ip = f"concat_ws('.', 1 + {octet(0)} % 223, {octet(1)}, {octet(2)}, 1 + {octet(3)} % 254)"
    thousand = lambda i: f"cast(conv(substring(hex, {8 * i + 1}, 8), 16, 10) AS long) % 1000"
    ip = f"IF(attempt > {ATTEMPTS}, concat_ws('.', {', '.join(thousand(i) for i in range(4))}), {ip})"
    ipv6 = f"concat_ws(':', {', '.join(f'substring(hex, {4 * i + 1}, 4)' for i in range(8))})"
    cases = []
    for script, syllables in SYLLABLES.items():
        table = "array(" + ", ".join(f"'{s}'" for s in syllables.split()) + ")"
        ending = "CASE gender " + " ".join(f"WHEN '{g}' THEN '{e}'" for g, e in ENDINGS[script].items()) + " END"
        stem = f"""array_join(transform(sequence(1, 3 + attempt),
                   i -> element_at({table}, cast(conv(substring(hex, i, 1), 16, 10) AS int) + 1)), '')"""
        cases.append(f"WHEN script = '{script}' THEN concat({stem}, {ending})")
    name = f"CASE {' '.join(cases)} END"
    chosen = f"""CASE WHEN kind = 'email' THEN {email} WHEN kind = 'ip' THEN {ip} WHEN kind = 'ipv6' THEN {ipv6}
                      WHEN kind IN ('given', 'family') THEN {name} WHEN kind = 'secret' THEN {secret}
                      ELSE {longer} END"""
    signs = ~F.regexp_like("form", F.lit(r"[\p{L}\p{N}]"))
    return {"hex": hex_, "digits": digits, "letters": letters, "signs": signs, "chosen": F.expr(chosen)}


def surrogates(forms: DataFrame, key: str) -> DataFrame:
    """(kind, form, gender, script, surrogate) for distinct forms, stored; no surrogate occurs twice in
    a kind, or as a form."""
    of = ["kind", "form", "gender", "script"]
    plan = drawn(key)

    def draw(df: DataFrame) -> DataFrame:
        df = df.withColumns({n: plan[n] for n in ("hex", "digits", "letters", "signs")})
        return df.select(*of, "attempt", plan["chosen"].alias("surrogate"))

    known, known_path = store(draw(forms.withColumn("attempt", F.lit(0))), "surrogates")
    originals = forms.select("kind", F.col("form").alias("surrogate")).distinct()
    for attempt in count(1):  # each attempt leaves less, as the choice grows
        first = known.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", *of)).alias("owner"))
        clashing = known.join(first, ["kind", "surrogate"]).where(F.struct("attempt", *of) != F.col("owner"))
        again = clashing.select(*of).unionAll(
            known.join(originals, ["kind", "surrogate"], "left_semi").select(*of)
        ).distinct()
        again, again_path = store(again, "clashes")
        if again.isEmpty():
            release(known.sparkSession, again_path)
            return known
        rest = known.join(again, of, "left_anti")
        new, path = store(rest.unionAll(draw(again.withColumn("attempt", F.lit(attempt)))), "surrogates")
        release(known.sparkSession, known_path)
        release(known.sparkSession, again_path)
        known, known_path = new, path


def written() -> Column:
    """A surrogate in the format of the value it replaces; digits beyond the value's own come last."""
    fill = """aggregate(
        split(value, ''), struct('' AS done, 1 AS i),
        (acc, c) -> IF(c RLIKE '[0-9A-Z]', struct(concat(acc.done, substring(surrogate, acc.i, 1)) AS done, acc.i + 1 AS i),
                       struct(concat(acc.done, c) AS done, acc.i AS i)),
        acc -> concat(acc.done, substring(surrogate, acc.i, char_length(surrogate))))"""
    numbers = F.col("kind").isin("card", "iban", "phone", "ssn")
    name = F.col("kind").isin("given", "family")
    shout = F.col("value") == F.upper("value")
    cased = F.when(shout & (F.char_length("value") > 1), F.upper("surrogate")).otherwise(F.initcap("surrogate"))
    quoted = F.when(F.startswith("value", F.lit('"')), F.concat(F.lit('"'), "surrogate", F.lit('"'))).otherwise(F.col("surrogate"))
    email = F.when(F.col("value") == F.upper("value"), F.upper("surrogate")).otherwise(F.col("surrogate"))
    return (
        F.when(numbers, F.expr(fill)).when(name, cased).when(F.col("kind") == "secret", quoted)
        .when(F.col("kind") == "email", email).otherwise(F.col("surrogate"))
    )


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_entities, text with surrogates."""
    texts = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text_col).alias("hash"), F.col(text_col).alias("text")
    )
    found, _ = store(mentions(texts), "mentions")
    of = ["kind", "form", "gender", "script"]
    table = surrogates(found.select(*of).distinct(), key)
    replaced = found.join(table, of).select("id", "hash", "place", "part", "head", "kind", written().alias("new"))
    # parts of a name join to the entity, entities to the list of their text
    gap = F.when(F.col("kind").isin("given", "family"), F.lit(" ")).otherwise("")
    entity = F.array_sort(F.collect_list(F.struct("part", "head", F.concat(gap, "new").alias("new"))))
    entities = replaced.groupBy("id", "hash", "place").agg(entity.alias("parts")).withColumn(
        "new", F.expr("concat(parts[0].head, array_join(transform(parts, x -> x.new), ''))")
    )
    listed = (
        entities.groupBy("id", "hash")
        .agg(F.array_sort(F.collect_list(F.struct("place", "new"))).alias("places"))
        .select(F.col("id").alias("of"), F.col("hash").alias("of_hash"), F.expr("transform(places, x -> x.new)").alias("news"))
    )
    same = F.col("id").eqNullSafe(F.col("of")) & (F.col("hash") == F.col("of_hash"))
    pieces = F.split("text", PATTERN, -1)
    whole = F.expr("array_join(flatten(zip_with(pieces, news, (s, n) -> array(s, coalesce(n, '')))), '')")
    joined = texts.join(listed, same, "left").withColumn("pieces", F.when(F.col("news").isNotNull(), pieces))
    return joined.select(
        F.col("id").alias(id_col),
        F.when(F.col("news").isNull(), 0).otherwise(F.size("news")).cast("long").alias("n_entities"),
        F.when(F.col("news").isNull(), F.col("text")).otherwise(whole).alias("text"),
    )
