"""Personal data by anchor expansion.

One Aho-Corasick pass over the whole text finds anchors: at-signs, schemes,
plus signs, digits, identifier cues and the fixed beginnings of keys. A small parser for the anchor's kind
then expands left and right from it and checks what it found, so the cost is
the scan plus the neighbourhoods of anchors, each of which is read once.

Base kinds (leftmost, non-overlapping per kind): email, ip, card, phone. Kinds
that the cues add: url (an address that names a user), iban (mod-97 checked),
account (a cued number of six digits or more), secret (a cued key or token
with digits, a password set off by a colon or equals sign, a key with a known
beginning, a signed web token, a private key block). IBANs are found without a cue
too, by a country's letters before digits, its length and the check. Positions are code points, end exclusive.

Null and empty texts have no spans; every input row gives one row, repeated or
not, with its id as it is (null stays null). Very long texts are scanned
whole. Only the id and text columns are read by ``find_spans``;
``redact_documents`` passes every other column through unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import map_arrow

# Kinds in the order of the result.
BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("url", "iban", "account", "secret")
KINDS = BASE_KINDS + ADDED_KINDS

ACCOUNT_CUES = ("account", "acct", "konto", "kontonummer", "compte", "cuenta", "ssn", "passport", "passeport",
                "reisepass", "pasaporte", "steuernummer", "social security")
SECRET_CUES = ("token", "api_key", "apikey", "api key", "api-key", "secret", "secret_key", "secret key", "access_key",
               "access key", "accesskey", "private_key", "bearer", "credential", "credentials")
PASSWORD_CUES = ("password", "passwd", "passphrase", "pwd", "passwort", "kennwort")
# Beginnings of keys that public services document, with the form of the whole.
KEYS = {**dict.fromkeys(("akia", "asia"), r"A[KS]IA[0-9A-Z]{16}(?![0-9A-Za-z])"),
        **dict.fromkeys(("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), r"gh[pousr]_[A-Za-z0-9]{30,}"),
        "github_pat_": r"github_pat_[A-Za-z0-9_]{22,}", "glpat-": r"glpat-[A-Za-z0-9_-]{20,}",
        **dict.fromkeys(("xoxa-", "xoxb-", "xoxp-", "xoxr-", "xoxs-"), r"xox[abprs]-[A-Za-z0-9-]{10,}"),
        **dict.fromkeys(("sk_live_", "sk_test_", "rk_live_", "rk_test_"), r"[sr]k_(?:live|test)_[A-Za-z0-9]{16,}"),
        "sk-": r"sk-[A-Za-z0-9_-]{20,}", "aiza": r"AIza[A-Za-z0-9_-]{35}", "npm_": r"npm_[A-Za-z0-9]{36}",
        "hf_": r"hf_[A-Za-z0-9]{30,}", "eyj": r"eyJ[A-Za-z0-9_-]{8,}"}
KEYS = {prefix: re.compile(form) for prefix, form in KEYS.items()}
# Lengths of IBANs by country, of the public registry.
IBAN_LENGTHS = dict(pair.split(":") for pair in """AD:24 AE:23 AL:28 AT:20 AZ:28 BA:20 BE:16 BG:22 BH:22 BR:29 BY:28 CH:21
CR:22 CY:28 CZ:24 DE:22 DK:18 DO:28 EE:20 EG:29 ES:24 FI:18 FO:18 FR:27 GB:22 GE:22 GI:23 GL:18 GR:27 GT:28 HR:21 HU:28
IE:22 IL:23 IQ:23 IS:26 IT:27 JO:30 KW:30 KZ:20 LB:28 LC:32 LI:21 LT:20 LU:20 LV:21 LY:25 MC:27 MD:24 ME:22 MK:19 MR:27
MT:31 MU:30 NL:18 NO:15 PK:24 PL:28 PS:29 PT:25 QA:29 RO:24 RS:22 SA:24 SC:31 SE:24 SI:19 SK:24 SM:27 ST:25 SV:28 TL:23
TN:24 TR:26 UA:29 VA:22 VG:24 XK:20""".split())

LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
SCHEME = frozenset("abcdefghijklmnopqrstuvwxyz0123456789+.-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
DIGITS = re.compile(r"[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
USER_URL = re.compile(r"[^\s/?#@<>\"']+@[A-Za-z0-9.\-\[\]:]*[A-Za-z0-9\]](?:[/?#][^\s<>\"']*[^\s<>\"'.,;:!?)\]}])?")
AFTER_CUE = re.compile(r"[\"']?[ \t]{0,4}(?:number|no\.?|nr\.?|id)?[ \t]{0,4}[:=#]?[ \t]{0,4}[\"']?")
ACCOUNT = re.compile(r"(?:[A-Za-z]{1,2}(?=[0-9]{6}))?[0-9](?:[ -]?[0-9]){5,33}(?![0-9])")
IBAN = re.compile(r"[A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]){11,30}")
# To the token's own end, however long.
SECRET = re.compile(r"[A-Za-z0-9_\-+/.]{8,}(?:={1,2}(?![A-Za-z0-9]))?")
VISIBLE = re.compile(r"[!#-&(-~]{6,}")      # ASCII, up to white space or a quote
TELLING = frozenset("0123456789!#$%^&*+=~@")
JWT_REST = re.compile(r"\.[A-Za-z0-9_-]{8,}(?:\.[A-Za-z0-9_-]*)*")
PEM = re.compile(r"-----BEGIN [A-Z0-9 ]{0,40}PRIVATE KEY(?: BLOCK)?-----(?:\s*(?:Proc-Type|DEK-Info|Version|Comment):[^\n]*)*"
                 r"(?:\s*[A-Za-z0-9+/]{16,}={0,2})*(?:\s*[A-Za-z0-9+/=]{0,20}\s*-----END [A-Z0-9 ]{0,40}"
                 r"PRIVATE KEY(?: BLOCK)?-----)?")

SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
SPAN_SCHEMA = "array<struct<kind: string, start: bigint, end: bigint>>"


def anchors():
    """The automaton of anchors (over text with A-Z lower-cased)."""
    import ahocorasick
    found = ahocorasick.Automaton()
    found.add_word("@", ("@", 1))
    found.add_word("+", ("+", 1))
    found.add_word("://", ("://", 3))
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
    found.add_word("iban", ("iban", 4))
    for cue in ACCOUNT_CUES:
        found.add_word(cue, ("account", len(cue)))
    for cue in SECRET_CUES:
        found.add_word(cue, ("secret", len(cue)))
    for cue in PASSWORD_CUES:
        found.add_word(cue, ("password", len(cue)))
    for prefix in KEYS:
        found.add_word(prefix, ("key", len(prefix)))
    found.add_word("-----begin ", ("pem", 11))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def small_part(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def iban_ok(value: str) -> bool:
    value = value.replace(" ", "").upper()
    if not 15 <= len(value) <= 34:
        return False
    return int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1


def longest_iban(value: str) -> int:
    """Length of the longest prefix that is a valid IBAN (0: none)."""
    for n in range(len(value), 14, -1):
        if value[n - 1] != " " and iban_ok(value[:n]):
            return n
    return 0


def iban_at(text: str, at: int) -> int:
    """The end of the IBAN of a known country that begins here (0: none)."""
    length = int(IBAN_LENGTHS.get(text[at:at + 2], 0))
    if not length or at and text[at - 1].isalnum() or not (m := IBAN.match(text, at)):
        return 0
    end, left = at, length
    while left and end < m.end():
        left -= text[end] != " "
        end += 1
    if left or text[end:end + 1].isalnum() or not iban_ok(text[at:end]):
        return 0
    return end


def spans_of(text: str, lowered: str, automaton) -> list[tuple[str, int, int]]:
    """All spans, by kind as listed and then by start. ``lowered`` is the text
    with A-Z in lower case (the same positions)."""
    found: dict[str, list[tuple[int, int]]] = {}
    done = dict.fromkeys(("email", "ip", "card", "phone", *ADDED_KINDS), 0)
    barren = 0  # end of a cued run that is no secret; what ends with it is none either
    spent: dict[str, int] = {}   # the same for runs after the beginning of a key

    def keep(kind: str, start: int, end: int) -> None:
        found.setdefault(kind, []).append((start, end))
        done[kind] = end

    for last, (kind, length) in automaton.iter(lowered):
        at = last + 1 - length
        if kind == "digit":
            if at >= done["ip"]:
                if m := IP.match(text, at):
                    if all(map(small_part, m.groups())):
                        keep("ip", at, m.end())
                    done["ip"] = m.end()
                else:
                    done["ip"] = DIGITS.match(text, at).end()
            if at >= done["card"]:
                if m := CARD.match(text, at):
                    digits = m.group().replace(" ", "").replace("-", "")
                    if 16 <= len(digits) <= 19 and luhn(digits):
                        keep("card", at, m.end())
                    done["card"] = m.end()
            if at >= 2 and "A" <= text[at - 1] <= "Z" and at - 2 >= done["iban"] and (end := iban_at(text, at - 2)):
                keep("iban", at - 2, end)
        elif kind == "+":
            if at >= done["phone"] and (m := PHONE.match(text, at)):
                if 8 <= sum(c in "0123456789" for c in m.group()) <= 15:
                    keep("phone", at, m.end())
                done["phone"] = m.end()
        elif kind == "@":
            start = at
            while start > done["email"] and text[start - 1] in LOCAL:
                start -= 1
            if start < at and (m := DOMAIN.match(text, at + 1)):
                keep("email", start, m.end())
        elif kind == "://":
            start = at
            while start > done["url"] and lowered[start - 1] in SCHEME:
                start -= 1
            while start < at and not lowered[start].isalpha():
                start += 1
            if start < at and (m := USER_URL.match(text, at + 3)):
                keep("url", start, m.end())
        elif kind == "pem":
            if at >= done["secret"] and (m := PEM.match(text, at)):
                keep("secret", at, m.end())
        elif kind == "key":
            prefix = lowered[at:last + 1]
            if at < max(done["secret"], spent.get(prefix, 0)) or at and (text[at - 1].isalnum() or text[at - 1] == "_"):
                continue
            if m := KEYS[prefix].match(text, at):
                rest = JWT_REST.match(text, m.end()) if prefix == "eyj" else m
                end = (rest or m).end()
                if rest and any(c in "0123456789" for c in text[at:end]):
                    keep("secret", at, end - (text[end - 1] == "."))
                else:
                    spent[prefix] = end
        elif kind == "password":
            gap = AFTER_CUE.match(text, last + 1).end()
            sign = text[last + 1:gap]
            if gap < max(done["secret"], barren) or not (":" in sign or "=" in sign) or not (m := VISIBLE.match(text, gap)):
                continue
            value = m.group()
            if sign[-1] not in "\"'":
                value = value.rstrip(".,;:!?)]}>")
            if len(value) >= 6 and any(map(str.isalpha, value)) and not TELLING.isdisjoint(value):
                keep("secret", gap, gap + len(value))
            else:
                barren = m.end()
        else:
            if at and (text[at - 1].isalnum() or text[at - 1] == "_") and kind != "secret":
                continue
            gap = AFTER_CUE.match(text, last + 1).end()
            sign = text[last + 1:gap]
            if not sign or at < done[kind]:
                continue
            if kind == "iban" and (m := IBAN.match(text, gap)):
                if n := longest_iban(m.group()):
                    keep("iban", gap, gap + n)
            elif kind == "account" and (m := ACCOUNT.match(text, gap)):
                keep("account", gap, m.end())
            elif kind == "secret" and gap >= max(barren, done["secret"]):
                quoted = text[gap - 1] in "\"'"
                if not (m := (VISIBLE if quoted else SECRET).match(text, gap)):
                    continue
                value = m.group() if quoted else m.group().rstrip(".")
                digits, letters = sum(c in "0123456789" for c in value), any(c.isalpha() for c in value)
                # a long value in both cases that is set off needs one digit only
                mixed = len(value) >= 16 and not value.islower() and not value.isupper() and (":" in sign or "=" in sign)
                if letters and digits >= (1 if mixed else 3 if quoted else 4):
                    keep("secret", gap, gap + len(value))
                else:
                    barren = m.end()
    return [(kind, a, b) for kind in KINDS for a, b in sorted(set(found.get(kind, ())))]


def redacted(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every run of overlapping spans replaced by the name of
    the first one's kind in brackets."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _both(column) -> Iterator[tuple[str, str]]:
    texts = pc.fill_null(column.cast(pa.large_string()), "")
    return zip(texts.to_pylist(), pc.ascii_lower(texts).to_pylist())


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id and ``spans``, by kind as listed, then start."""
    def run(batches):
        automaton = anchors()
        for b in batches:
            spans = [[{"kind": k, "start": s, "end": e} for k, s, e in spans_of(t, low, automaton)]
                     for t, low in _both(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, SPAN_TYPE)], ["doc_id", "spans"])

    two = docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))
    kind = two.schema["doc_id"].dataType.simpleString()
    return map_arrow(two, run, f"doc_id {kind}, spans {SPAN_SCHEMA}")


def redact_documents(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """The documents with personal data replaced by ``[KIND]``; a code-point
    count column, if there is one, follows the new text. Null texts stay null."""
    names = docs.columns
    text_at = names.index(text_col)
    chars_at = names.index(chars_col) if chars_col in names else None

    def run(batches):
        automaton = anchors()
        for b in batches:
            new = [redacted(t, s) if (s := spans_of(t, low, automaton)) else t for t, low in _both(b.column(text_at))]
            columns = list(b.columns)
            old = columns[text_at]
            columns[text_at] = pc.if_else(old.is_valid(), pa.array(new, old.type), pa.nulls(len(old), old.type))
            if chars_at is not None:
                changed = pc.fill_null(pc.not_equal(columns[text_at], old), False)
                columns[chars_at] = pc.if_else(changed, pc.utf8_length(columns[text_at]).cast(b.column(chars_at).type),
                                               columns[chars_at])
            yield pa.RecordBatch.from_arrays(columns, names)

    return map_arrow(docs, run, docs.schema)


def digest(spans: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """``kind:start:end`` of the spans (of these kinds), comma-joined."""
    chosen = spans if kinds is None else F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                  s["end"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
