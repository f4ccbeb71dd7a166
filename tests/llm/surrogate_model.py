"""Surrogates once more in plain Python: find, draw, settle, replace."""

from __future__ import annotations

import hashlib

import regex

from tidemark.llm import surrogates as s


def translated(pattern: str) -> str:
    """A pattern of Java for the regex module: digits and word signs are ASCII, the end is the very end."""
    out, inside = [], False
    for token in regex.findall(r"\\p\{\w+\}|\\.|.", pattern, regex.DOTALL):
        if token == r"\d":
            token = "0-9" if inside else "[0-9]"
        elif token == r"\w":
            token = "A-Za-z0-9_" if inside else "[A-Za-z0-9_]"
        elif token == r"\s":
            token = r" \t\n\x0b\f\r" if inside else r"[ \t\n\x0b\f\r]"
        elif token == r"\z":
            token = r"\Z"
        inside = token == "[" or inside and token != "]"
        out.append(token)
    return "".join(out)


FIND = regex.compile(translated(s.PATTERN))
KINDS = {k: regex.compile(f"(?:{translated(p)})") for k, p in s.PATTERNS.items()}
HEADS = {
    "name": regex.compile(r"([\p{L}]+\.?) "),
    "phone": regex.compile(r"((?:\+|00)[0-9]{1,3}(?=[^0-9])|\+[0-9]|00[0-9])"),
    "secret": regex.compile(f"({translated(s.BEGIN)}|AKIA|ASIA|{translated(s.BARE)}|{translated(s.NAMED)})"),
    "email": regex.compile(r"([._%+-]*)"),
    "iban": regex.compile("(..)"),
}


def mentions(text: str) -> list[tuple[int, int, str, list[tuple]]]:
    """Begin, end, head and parts (kind, form, gender, script, value) of each entity."""
    out = []
    for match in FIND.finditer(text):
        whole = match[0]
        kind = next((k for k, p in KINDS.items() if k != "name" and p.fullmatch(whole)), "name")
        found = HEADS[kind].match(whole) if kind in HEADS else None
        head = found[1] if found else ""
        rest = whole[len(head) :]
        values = rest.strip(" ").split(" ") if kind == "name" else [rest]
        title = regex.match(r"([\p{L}]+)\.? ", whole)
        parts = []
        for n, value in enumerate(values):
            given = kind == "name" and n < len(values) - 1
            gender = next((g for g in ("male", "female") if title and title[1] in s.TITLES[g]), "") if given else ""
            script = ""
            if kind == "name":
                script = "cyrillic" if regex.search(r"\p{Cyrillic}", value) else "greek" if regex.search(r"\p{Greek}", value) else "latin"
            if kind in ("card", "phone", "ssn"):
                form = regex.sub("[^0-9]", "", value)
            elif kind == "iban":
                form = value.replace(" ", "")
            elif kind == "secret":
                form = value.replace('"', "")
            else:
                form = value.lower()
            parts.append(((("given" if given else "family") if kind == "name" else kind), form, gender, script, value))
        out.append((*match.span(), head, parts))
    return out


def draw(key: str, kind: str, form: str, gender: str, script: str, attempt: int) -> str:
    parts = "\x1f".join([key, kind, form, gender, script, str(attempt)])
    hexes = hashlib.sha256(parts.encode()).hexdigest() + hashlib.sha256(f"+{parts}".encode()).hexdigest()
    digits = hexes.translate(str.maketrans("abcdef", "012345"))
    letters = hexes.translate(str.maketrans("0123456789", "ghijkmnpqr"))
    signs = not regex.search(r"[\p{L}\p{N}]", form)
    walk = ""
    for i, c in enumerate(form):
        if regex.match(r"\p{N}", c):
            walk += digits[i % 128]
        elif regex.match(r"\p{Lu}", c):
            walk += letters[i % 128].upper()
        else:
            walk += letters[i % 128] if signs or regex.match(r"\p{L}", c) else c
    wider = letters[99 : 100 + attempt] if attempt else ""
    if kind == "email":
        label = form.rsplit(".", 1)[-1]
        return wider + walk[: len(form) - len(label)] + label
    if kind == "ip":
        if attempt > s.ATTEMPTS:
            return ".".join(str(int(hexes[8 * i : 8 * i + 8], 16) % 1000) for i in range(4))
        a, b, c, d = (int(hexes[2 * i : 2 * i + 2], 16) for i in range(4))
        return f"{1 + a % 223}.{b}.{c}.{1 + d % 254}"
    if kind == "ipv6":
        return ":".join(hexes[4 * i : 4 * i + 4] for i in range(8))
    if kind in ("given", "family"):
        syllables = s.SYLLABLES[script].split()
        return "".join(syllables[int(h, 16)] for h in hexes[: 3 + attempt]) + s.ENDINGS[script][gender]
    if kind == "secret":
        return wider + walk
    return walk + digits[99 : 99 + max(attempt - s.ATTEMPTS, 0)]


def settled(forms: set[tuple], key: str) -> dict[tuple, str]:
    """Surrogate of each (kind, form, gender, script)."""
    originals = {(kind, form) for kind, form, *_ in forms}
    known = {f: (0, draw(key, *f, 0)) for f in forms}
    attempt = 0
    while True:
        attempt += 1
        owners = {}
        for f, (n, new) in known.items():
            rank = (n, *(p.encode() for p in f))
            owners[f[0], new] = min(owners.get((f[0], new), rank), rank)
        again = [
            f for f, (n, new) in known.items()
            if owners[f[0], new] != (n, *(p.encode() for p in f)) or (f[0], new) in originals
        ]
        if not again:
            return {f: new for f, (_, new) in known.items()}
        known.update({f: (attempt, draw(key, *f, attempt)) for f in again})


def written(kind: str, value: str, new: str) -> str:
    if kind in ("card", "iban", "phone", "ssn"):
        out, i = "", 0
        for c in value:
            takes = regex.match("[0-9A-Z]", c)
            out += new[i : i + 1] if takes else c
            i += bool(takes)
        return out + new[i:]
    if kind in ("given", "family"):
        return new.upper() if value == value.upper() and len(value) > 1 else new.capitalize()
    if kind == "secret":
        return f'"{new}"' if value.startswith('"') else new
    return new.upper() if kind == "email" and value == value.upper() else new


def pseudonymised(rows: list[tuple], key: str) -> list[tuple]:
    """(id, number of entities, text) for rows (id, text)."""
    found = [(i, text, mentions(text) if text else []) for i, text in rows]
    table = settled({p[:4] for _, _, every in found for m in every for p in m[3]}, key)
    out = []
    for i, text, every in found:
        done, at = "", 0
        for begin, end, head, parts in every:
            gap = " " if parts[0][0] in ("given", "family") else ""
            done += text[at:begin] + head + "".join(gap + written(p[0], p[4], table[p[:4]]) for p in parts)
            at = end
        out.append((i, len(every), done + text[at:] if text is not None else None))
    return out
