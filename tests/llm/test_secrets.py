import base64
import bz2
import gzip
import hashlib
import lzma
import random
import os
import re
import subprocess
import sys
import urllib.parse
import zlib

import pytest
import zstandard
from frames import SF, awkward, documents, groups, read

from fareline.llm import secrets
from fareline.llm.queries import LLM_QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SECRET = 'password = "hunter2secret9"'


def plain_spans(text):
    """Base spans as they are described: match, then drop what is too short."""
    found = [(m.start(), 0, m.end()) for m in re.finditer(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A)
        if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def test_base_spans_of_random_texts():
    rng = random.Random(3)
    parts = ["token", "Secret", "API_KEY", "apikey", "=", ":", '"', "'", " ", "abcdef", "x", "AKIA", "ABCDEF0123456789", "é",
             "0123456789abcdef", "deadbeef", "%3D", "\\u003d", "/", ".", "ſecret", "K", "%", "\\", "&#", "\\ud800", "%1F%8B"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 20)))
        assert secrets.base_spans(text) == plain_spans(text)
        assert set(secrets.all_spans(text)) >= set(plain_spans(text))


def layered(data):
    return {
        "url": urllib.parse.quote(data.decode()),
        "url twice": urllib.parse.quote(urllib.parse.quote(data.decode())),
        "unicode": "".join(f"\\u{ord(c):04x}" for c in data.decode()),
        "braces": "".join(f"\\u{{{ord(c):x}}}" for c in data.decode()),
        "bytes": "".join(f"\\x{c:02x}" for c in data),
        "references": "".join(f"&#{c};" for c in data),
        "base64": base64.b64encode(data).decode(),
        "url-safe base64": base64.urlsafe_b64encode(b"\xc3\xbf\xc3\xbf " + data).decode().rstrip("="),
        "wrapped base64": base64.encodebytes(b"z" * 90 + b" " + data).decode(),
        "base64 thrice": base64.b64encode(base64.b64encode(base64.b64encode(data))).decode(),
        "gzip": base64.b64encode(gzip.compress(data)).decode(),
        "zlib": base64.b64encode(zlib.compress(data)).decode(),
        "zstandard": base64.b64encode(zstandard.compress(data)).decode(),
        "bzip2": base64.b64encode(bz2.compress(data)).decode(),
        "xz": base64.b64encode(lzma.compress(data)).decode(),
        "gzip in percent escapes": "".join(f"%{b:02X}" for b in gzip.compress(data)),
        "base64 in zlib in base64 in url": urllib.parse.quote(base64.b64encode(zlib.compress(base64.b64encode(data))).decode()),
    }


@pytest.mark.parametrize("name", list(layered(b"x")))
@pytest.mark.parametrize("lead", ["", "é𝒳 words before "])
def test_layers_are_unwrapped_and_mapped(name, lead):
    text = f"{lead}<{layered(SECRET.encode())[name]}> and more words"
    spans = [s for s in secrets.all_spans(text) if s not in secrets.base_spans(text)]
    assert spans and {kind for _, kind, _ in spans} == {0}
    begin, end = len(lead) + 1, text.rindex(">")
    assert all(begin <= start < stop <= end for start, _, stop in spans)
    hidden = secrets.masked(text, secrets.all_spans(text))
    assert secrets.MASK in hidden and hidden.startswith(lead) and hidden.endswith(" and more words")
    assert not [s for s in secrets.all_spans(hidden) if s[1] == 0]


def test_spans_are_as_narrow_as_the_encoding_allows():
    text = "x" + base64.b64encode(b"nothing to see here " + b"token: abcdefgh" + b" nor here, really").decode()
    (start, _, end), = secrets.all_spans(text[1:])
    assert base64.b64decode(text[1:][start - start % 4:end + -end % 4]).strip().startswith((b"token", b"e token", b" token"))
    escaped = "pass\\u0077ord=abcdefgh tail"
    assert secrets.all_spans(escaped) == [(0, 0, escaped.index(" "))]


def test_clean_text_with_long_words_has_no_spans():
    text = "Donaudampfschifffahrtsgesellschaftskapitaen 100% sure \\u00e9t\\u00e9 " + base64.b64encode(b"plain words only").decode()
    assert secrets.all_spans(text) == []


def test_a_layer_that_holds_itself_ends(monkeypatch):
    """A decoder that always gives the same layer again must not go on for ever."""
    monkeypatch.setattr(secrets, "_base64_layers", lambda layer: iter([secrets.Layer("%41 loop", *secrets._whole(
        secrets.Layer("loop text"), 0, 4, 8))]))
    assert secrets.all_spans("loop text") == []


def test_bombs_are_opened_a_part_at_a_time(monkeypatch):
    monkeypatch.setattr(secrets, "PART_BYTES", 1 << 16)
    bomb = base64.b64encode(gzip.compress(SECRET.encode() + b" " * (1 << 22) + SECRET.encode())).decode()
    assert secrets.all_spans(bomb)
    monkeypatch.setattr(secrets, "LARGEST_LAYER", 1 << 17)
    late = base64.b64encode(gzip.compress(b" " * (1 << 22) + SECRET.encode())).decode()
    assert secrets.all_spans(late) == []
    broken = base64.b64encode(gzip.compress(b"x" * 500)[:40]).decode()
    assert secrets.all_spans(broken) == []


def test_query_against_brute_force(spark):
    texts = {r.doc_id: r.text or "" for r in read(spark, SF).collect()}
    rows = LLM_QUERIES["op10_secrets"](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain_spans(texts[r.doc_id])
        joined = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in base) for i in range(3)]
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))


def test_awkward_rows(spark):
    by_id = groups((r.doc_id, r) for r in secrets.scan(awkward(spark)).collect())
    assert sum(map(len, by_id.values())) == 10 and by_id[1][0].base == by_id[1][0].spans == []
    docs = documents(spark, None, "", "plain", f"say {SECRET} twice {SECRET}")
    masked = secrets.mask_secrets(docs).collect()
    assert [r.text for r in masked] == [None, "", "plain", 'say [SECRET]" twice [SECRET]"']
    assert [r.n_chars for r in masked] == [None, 0, 5, len(masked[3].text)]
    assert secrets.mask_secrets(awkward(spark)).columns == awkward(spark).columns
    assert secrets.mask_secrets(awkward(spark)).count() == 10
    assert secrets.scan(docs.filter("false")).count() == 0


PAYLOADS = {
    "plain": b"token=abcdef", "longer": b"id 7, token=abcdefgh, more words follow here and go on for a line or two of text",
    "gzip": gzip.compress(b"token=abcdef"), "zstandard": zstandard.compress(b"token=abcdef"), "xz": lzma.compress(b"token=abcdef")}
AROUND = ["DATA={}\nPORT=8080", "{}\nend", "d41d8cd98f00b204e9800998ecf8427e\n{}\n", "https://example/x/{}", "a/{}/next-part_of/path",
          "{}\nQmFzZTY0LW90aGVyLWxpbmU\n", "prefix-{}", "pre_fix_name-{}-suffix_word"]


@pytest.mark.parametrize("name", list(PAYLOADS))
@pytest.mark.parametrize("around", AROUND)
@pytest.mark.parametrize("encode", [base64.b64encode, base64.urlsafe_b64encode, base64.encodebytes])
def test_base64_next_to_other_lines_and_in_paths(name, around, encode):
    payload = encode(PAYLOADS[name]).decode().strip()
    text = around.format(payload)
    begin = around.index("{")
    hidden = [s for s in secrets.all_spans(text) if s[1] == 0]
    assert any(begin <= start < stop <= begin + len(payload) for start, _, stop in hidden)
    assert not [s for s in secrets.all_spans(secrets.masked(text, secrets.all_spans(text))) if s[1] == 0]


@pytest.mark.parametrize("pack", [gzip.compress, zlib.compress, zstandard.compress, bz2.compress, lzma.compress])
@pytest.mark.parametrize("write", [urllib.parse.quote, urllib.parse.quote_plus, repr,
                                   lambda data: "".join(f"\\x{b:02x}" for b in data),
                                   lambda data: "".join(f"\\u{b:04x}" for b in data)])
@pytest.mark.parametrize("data", [SECRET.encode(), b"one line\nand +token+ = more of it " * 9 + SECRET.encode()])
def test_compressed_bytes_as_urls_and_programs_write_them(pack, write, data):
    payload = write(pack(data))
    text = f"say {payload} and more words"
    hidden = [s for s in secrets.all_spans(text) if s[1] == 0]
    assert hidden and all(4 <= start < stop <= 4 + len(payload) for start, stop in {(a, b) for a, _, b in hidden})
    assert secrets.masked(text, secrets.all_spans(text)).endswith(" and more words")


BINARY = {
    "bytes at the start": b"\xff\x00 x password=hunter2secret y", "a control character": b"\x01\x02password=hunter2secret",
    "latin-1": "café password=hunter2secret".encode("latin-1"), "utf-16": "password=hunter2secret".encode("utf-16"),
    "utf-16 big end first": "x password=hunter2secret".encode("utf-16-be"), "in other bytes": bytes(range(256)) * 9 + b" token: abcdefgh\x00"}


@pytest.mark.parametrize("name", list(BINARY))
@pytest.mark.parametrize("pack", [bytes, gzip.compress, zlib.compress, zstandard.compress, bz2.compress, lzma.compress,
                                  lambda data: gzip.compress(zstandard.compress(data))])
def test_texts_among_other_bytes_are_found(name, pack):
    payload = base64.b64encode(pack(BINARY[name])).decode()
    text = f"say <{payload}> and more"
    hidden = [s for s in secrets.all_spans(text) if s[1] == 0]
    assert hidden and all(5 <= start < stop <= 5 + len(payload) for start, _, stop in hidden)


@pytest.mark.parametrize("pack", [gzip.compress, zstandard.compress, bz2.compress, lzma.compress])
def test_all_members_are_read(pack):
    payload = base64.b64encode(pack(b"nothing here, only words") + pack(b"words and " + SECRET.encode())).decode()
    assert [s for s in secrets.all_spans(payload) if s[1] == 0]
    cut = base64.b64encode(pack(b"words " + SECRET.encode()) + pack(bytes(5000))[:9]).decode()
    assert [s for s in secrets.all_spans(cut) if s[1] == 0]


@pytest.mark.parametrize("at", [0, 1 << 20, (1 << 20) - 13, (3 << 20) + 5])
def test_secrets_on_the_edge_of_parts(at):
    data = (b"word " * (1 << 20))[:at] + b" " + SECRET.encode() + b" more" * (1 << 18)
    text = base64.b64encode(gzip.compress(data)).decode()
    assert [s for s in secrets.all_spans(text) if s[1] == 0]


def test_compressed_bytes_amid_decompressed_ones_go_on_beyond_their_part():
    rng = random.Random(1)
    inner = gzip.compress(bytes(rng.randrange(256) for _ in range(1_500_000)) + b" " + SECRET.encode())
    text = base64.b64encode(zlib.compress(b"a file name\n" + b"pad " * 200_000 + inner + b" tail")).decode()
    assert [s for s in secrets.all_spans(text) if s[1] == 0]


def test_a_layer_of_a_hundred_megabytes_in_little_memory():
    code = """
import base64, gzip, resource, sys
from fareline.llm import secrets
data = gzip.compress(b"some words in a line\\n" * 5_000_000 + b"password = hunter2secret9")
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
found = secrets.all_spans("x " + base64.b64encode(data).decode())
assert found and found[0][1] == 0
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    made = subprocess.run([sys.executable, "-c", code.replace('b"some words in a line\\\\n"', 'b"some words in a line\\n"')],
                          cwd=ROOT, check=True, capture_output=True, text=True)
    assert int(made.stdout) < 300


def test_columns_in_another_case(spark):
    docs = documents(spark, f"say {SECRET} twice").withColumnsRenamed({"text": "TEXT", "n_chars": "N_Chars"})
    masked = secrets.mask_secrets(docs).first()
    assert masked.TEXT == 'say [SECRET]" twice' and masked.N_Chars == len(masked.TEXT)
