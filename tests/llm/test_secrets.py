import base64
import bz2
import gzip
import hashlib
import html
import json
import lzma
import random
import re
import time
import urllib.parse
import zlib

import pytest
from hypothesis import given, settings, strategies as st

from fieldstat.llm import queries, secret_scan
from fieldstat.llm.secret_scan import findings, written

from .conftest import as_lists, edge_texts

SECRET = 'password = "Tr0ub4dor.and-3"'


def plain_base(text):
    """The base patterns as they are stated."""
    patterns = [("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
                ("access", r"AKIA[A-Z0-9]+", 0, 16), ("hex", r"[0-9a-f]+", 0, 32)]
    found = [(m.start(), k, m.end(), kind) for k, (kind, p, g, n) in enumerate(patterns)
             for m in re.finditer(p, text, re.A) if len(m.group(g)) >= n]
    return [(kind, a, b) for a, _, b, kind in sorted(found)]


def only(text):
    """Spans that the layers add."""
    base, spans = findings(text)
    assert set(base) <= set(spans)
    return [f for f in spans if f not in base]


def b64(data):
    return base64.b64encode(data.encode() if isinstance(data, str) else data).decode()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["password", "PassWd", "api_key", "apikey", "secret", "token", "=", ":", " ", '"', "'", "AKIA",
                                 "ABCDEFGHIJKLMNOP", "abcdef0123456789", "xyz", "é", "\n", "ſecret", "K", "1", "/+", "%20"])))
def test_base_findings(parts):
    text = "".join(parts)
    assert secret_scan.base_findings(text) == plain_base(text)
    assert findings(text)[0] == plain_base(text)


def test_each_layer_maps_to_its_span():
    for wrap in (
        lambda s: urllib.parse.quote(s, safe=""), lambda s: "".join(f"\\u{ord(c):04x}" for c in s),
        lambda s: "".join(f"&#{ord(c)};" for c in s), lambda s: "".join(f"\\x{ord(c):02x}" for c in s), b64,
        lambda s: b64(gzip.compress(s.encode())), lambda s: b64(zlib.compress(s.encode())),
        lambda s: b64(bz2.compress(s.encode())), lambda s: b64(lzma.compress(s.encode())),
        lambda s: base64.urlsafe_b64encode(gzip.compress(gzip.compress(s.encode()))).decode().rstrip("="),
    ):
        hidden = wrap(SECRET)
        text = f"ñ before {hidden} after"
        found = only(text)
        assert [f[0] for f in found] == ["assign"], hidden
        start, end = found[0][1:]
        assert 9 <= start < end <= 9 + len(hidden)
    percent = "x" + urllib.parse.quote(SECRET, safe="").replace("p", "%70", 1)
    assert only(percent)[0][1] == 1


def test_nested_layers_until_fixpoint():
    deep = SECRET
    for wrap in (b64, lambda s: urllib.parse.quote(s, safe=""), lambda s: b64(gzip.compress(s.encode())),
                 lambda s: "".join(f"\\u{ord(c):04x}" for c in s), b64):
        deep = wrap(deep)
    assert [f[0] for f in only(f"see {deep}!")] == ["assign"]


def test_part_of_a_finding_is_encoded():
    text = "token=abc%64efghij rest"
    base, spans = findings(text)
    assert base == [] and spans == [("assign", 0, 18)]


def test_cycles_and_odd_payloads_end():
    for text in ("%25" * 50 + "41", "%2525252541", "\\u005cu0041", "\\ud800\\ud800", "&#0;&#xD800;&#1114112;", "A" * 17,
                 b64(b"\x1f\x8b" + b"\0" * 30), b64(b"BZh9" + b"\0" * 30), "=" * 40, "%FF%FE", "%E2%82%AC" * 5):
        findings(text)


def test_payload_bomb_is_bounded(monkeypatch):
    monkeypatch.setattr(secret_scan, "INFLATED", 1 << 16)
    bomb = b64(gzip.compress(SECRET.encode() + b" " + b"0 " * 2_000_000))
    began = time.time()
    assert only(bomb)[0][0] == "assign" and time.time() - began < 5


def test_long_payloads_are_scanned_in_windows(monkeypatch):
    monkeypatch.setattr(secret_scan, "WINDOW", 5000)
    monkeypatch.setattr(secret_scan, "OVERLAP", 100)
    monkeypatch.setattr(secret_scan, "_HEAD", 1000)
    for at in (0, 4980, 4999, 5000, 20_000, 29_900):
        inner = ("0 " * 20_000)[:at].encode() + b" " + SECRET.encode() + b" " + ("0 " * 20_000)[at:].encode()
        hidden = b64(gzip.compress(gzip.compress(inner)))
        text = f"é {hidden} and {hidden}"  # equal payloads at two places
        spans = only(text)
        assert [f[0] for f in spans] == ["assign"] * 2, at
        assert spans[0][1] >= 2 and spans[0][2] == 2 + len(hidden) and spans[1][1] >= 2 + len(hidden)
    url = urllib.parse.quote(b64(SECRET), safe="").replace("c", "%63")
    assert [f[0] for f in only(b64(bz2.compress(b"0 " * 9000 + url.encode())))] == ["assign"]


def test_members_and_damaged_payloads():
    first, second = gzip.compress(b"nothing here"), gzip.compress(SECRET.encode())
    assert [f[0] for f in only(b64(first + second))] == ["assign"]
    noise = random.Random(3).randbytes(50_000)
    cut = gzip.compress(SECRET.encode() + b"\n" + noise)[:-20_000]
    assert [f[0] for f in only(b64(cut))] == ["assign"]
    assert [f[0] for f in only(b64(gzip.compress(b"x^ " + SECRET.encode())))] == ["assign"]


def test_payloads_that_are_not_printable():
    raw = SECRET.encode()
    for data in ("\ufeff" + SECRET, "\xa0" + SECRET, "\u200b" + SECRET, SECRET + "\0", "\x0c\x1b" + SECRET, SECRET + "\u2028",
                 "é ".encode("latin-1") + raw, b"\xff\x00\xfe" + raw + b"\x80", SECRET.encode("utf-16"), SECRET.encode("utf-16-be"),
                 b"\xff" + SECRET.encode("utf-16-le"), SECRET.encode("utf-32"), gzip.compress(SECRET.encode("utf-16"))):
        hidden = b64(data)
        assert only(f"é {hidden} x") == [("assign", 2, 2 + len(hidden))], data


def test_what_stands_before_a_payload():
    for data in (SECRET, SECRET + "~" * 50, gzip.compress(SECRET.encode()), lzma.compress(SECRET.encode())):
        for head in ("/v1/", "k_", "a-", "abc/d/", "x", "xy", "xyz", "wxyz+"):
            for tail in ("", "A", "/A", "_AB"):
                hidden = head + b64(data).rstrip("=") + tail
                assert [f[0] for f in only(f"é {hidden} x")] == ["assign"], (head, data)


def test_compressed_bytes_in_escapes():
    noise = random.Random(5).randbytes(700)
    ways = (
        lambda d: "".join(f"%{c:02X}" for c in d), lambda d: urllib.parse.quote(d), lambda d: urllib.parse.quote_plus(d),
        lambda d: urllib.parse.quote(d.decode("latin-1")), lambda d: "".join(f"\\x{c:02x}" for c in d), lambda d: repr(d)[2:-1],
        lambda d: "".join(f"\\u{c:04x}" for c in d), lambda d: json.dumps(d.decode("latin-1"))[1:-1],
        lambda d: "".join(f"&#{c};" for c in d), lambda d: html.escape(d.decode("latin-1")).encode("ascii", "xmlcharrefreplace").decode())
    for pack in (gzip.compress, zlib.compress, bz2.compress, lzma.compress):
        for body in (SECRET.encode(), noise.hex(" ", 3).encode() + SECRET.encode()):
            for i, way in enumerate(ways):
                hidden = way(pack(body))
                found = [f for f in only(f"é {hidden} x") if f[0] == "assign"]
                assert any(a == 2 and 2 + len(hidden) - 12 <= b <= 3 + len(hidden) for _, a, b in found), (pack, i, found)
                assert "assign" in [f[0] for f in only(b64(gzip.compress(way(pack(body)).encode())))], (pack, i)
                assert "assign" in [f[0] for f in only(urllib.parse.quote(hidden))], (pack, i)


def test_base64_over_lines():
    rng = random.Random(6)
    plain = [f"{'n' * k} {SECRET}".encode() for k in (0, 40, 46, 50, 54, 57, 90)]
    packed = [pack(SECRET.encode() + rng.randbytes(400).hex(" ", 2).encode()) for pack in (gzip.compress, bz2.compress, lzma.compress)]
    for data in plain + packed:
        for width in (8, 10, 64, 76):
            for between in ("\n", "\r\n", "\n    ", "\n\t", "\\n"):
                code = b64(data)
                hidden = between.join(code[i:i + width] for i in range(0, len(code), width))
                for text in (f"é\n{hidden}\nend of it", f"é {hidden} x", f"é\nword\n{hidden}", f"é {b64(hidden)} x"):
                    found = only(text)
                    assert "assign" in [f[0] for f in found], (text, data, width)
                    assert all(2 <= a < b <= len(text) for _, a, b in found)
    text = "é\n" + base64.encodebytes(b"n" * 100 + b" " + SECRET.encode() + b" " + b"n" * 100).decode()
    lines = text.split("\n")
    assert only(text) == [("assign", 2 + len(lines[1]) + 1, 2 + sum(len(x) + 1 for x in lines[1:4]) - 1)]


def test_nested_payloads_over_window_borders(monkeypatch):
    monkeypatch.setattr(secret_scan, "WINDOW", 5000)
    monkeypatch.setattr(secret_scan, "OVERLAP", 100)
    monkeypatch.setattr(secret_scan, "_HEAD", 1000)
    rng = random.Random(8)
    noise = rng.randbytes(6000).hex(" ", 3)
    body = noise[:6000] + " " + SECRET + " " + noise[6000:]
    packed = gzip.compress(body.encode())
    nested = [b64(body).encode(), b64(packed).encode(), base64.encodebytes(packed), urllib.parse.quote(packed, safe="").encode(),
              "".join(f"\\x{c:02x}" for c in packed).encode(), packed, bz2.compress(body.encode()),
              ('password = "' + "x" * 12_000).encode()]
    for n, inner in enumerate(nested):
        for at in (1, 4001, 4990, 9000):
            hidden = b64(gzip.compress(("0 " * 8000)[:at].encode() + b" " + inner + b" " + b"0 " * 4000))
            base, spans, whole = secret_scan.examined(f"é {hidden} x")
            assert ("assign", 2, 2 + len(hidden)) in spans and whole, (n, at)


def test_no_end_of_inflated_bytes(monkeypatch):
    monkeypatch.setattr(secret_scan, "INFLATED", 1 << 16)
    monkeypatch.setattr(secret_scan, "WINDOW", 1 << 14)
    monkeypatch.setattr(secret_scan, "OVERLAP", 1 << 10)
    monkeypatch.setattr(secret_scan, "_HEAD", 1 << 12)
    _, spans, whole = secret_scan.examined(b64(gzip.compress(b"0 " * 200_000 + SECRET.encode())))
    assert [f[0] for f in spans] == ["assign"] and whole
    assert not secret_scan.examined(b64(gzip.compress(b"Z" * 300_000 + b" " + SECRET.encode())))[2]  # a run that is too long


def test_scan_on_edges(edges):
    docs = [*edge_texts()]
    want = [(d, *(sum(f[0] == k for f in plain_base(t or "")) for k in secret_scan.KINDS), written(plain_base(t or "")))
            for d, t in docs]
    assert as_lists(secret_scan.scan(edges), "doc_id", "n_assign", "n_access", "n_hex", "base") == sorted(want, key=repr)


def test_query_against_the_stated_patterns(spark, sf, sf_docs):
    rows = queries.op7_secret_worklist(spark, sf)
    want = []
    for d, t in sf_docs:
        base = plain_base(t)
        want.append((d, *(sum(f[0] == k for f in base) for k in secret_scan.KINDS),
                     hashlib.sha256(written(base).encode()).hexdigest()))
    assert as_lists(rows, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == sorted(want, key=repr)


def test_redact(spark, edges, no_docs):
    hidden = b64(SECRET)
    docs = spark.createDataFrame(
        [(1, f"a {SECRET} b {hidden} c", 9, "x"), (2, None, None, None), (3, "clean", 5, None),
         (4, 'secret: "token=abcdefghij" é', 9, "y")], "doc_id long, text string, n_chars int, spans string")
    got = {r.doc_id: r for r in secret_scan.redact(docs).collect()}
    assert got[1].text == "a <SECRET>\" b <SECRET> c" and got[1].n_chars == len(got[1].text)
    assert got[2].text is None and got[2].n_chars is None and got[3] == docs.filter("doc_id = 3").first()
    assert "abcdefghij" not in got[4].text and got[4].text.endswith(" é")
    assert secret_scan.redact(edges).count() == len(edge_texts()) and secret_scan.redact(edges).schema == edges.schema
    assert secret_scan.redact(no_docs).count() == 0 and secret_scan.scan(no_docs).count() == 0
    assert json.dumps(got[3].asDict())


@pytest.mark.parametrize("text", [
    "".join(f"\\{ord(c):03o}" for c in "password=hunter2222"),
    "pass\\u{77}ord=hunter2222", "passwor\\x{64}=hunter2222", "password&equals;hunter2222", "password&colon;&nbsp;x password&equals;hunter2222",
    "password+%3D+hunter2222",
])
def test_further_written_forms(text):
    assert [f for f in secret_scan.findings(text)[1] if f[0] == "assign"], text


@pytest.mark.parametrize("pack", ["deflate", "lzma alone"])
def test_further_compressions(pack):
    data = b"some words and password=hunter2222 and more words " * 3
    if pack == "deflate":
        c = zlib.compressobj(wbits=-15)
        packed = c.compress(data) + c.flush()
    else:
        packed = lzma.compress(data, lzma.FORMAT_ALONE)
    text = "x " + base64.b64encode(packed).decode() + " y"
    assert ("assign", 2, len(text) - 2) in secret_scan.findings(text)[1]


def test_plain_texts_with_ampersands_and_octal_digits_have_no_findings():
    for text in ("A & B; C &amp; D", "C:\\123\\456", "a+b%20c", "AT&T; x&y;"):
        assert secret_scan.findings(text) == ([], [])


def test_a_payload_that_must_be_cut_is_taken_out(monkeypatch):
    """What cannot be read as a whole does not pass redaction as clean."""
    monkeypatch.setattr(secret_scan, "INFLATED", 1 << 16)
    monkeypatch.setattr(secret_scan, "WINDOW", 1 << 14)
    monkeypatch.setattr(secret_scan, "OVERLAP", 1 << 10)
    payload = base64.b64encode(zlib.compress(b"A" * (1 << 18))).decode()
    base, spans, cut = secret_scan.unwrapped("before " + payload + " after")
    assert base == spans == [] and set(cut) == {(7, 7 + len(payload))}
    assert secret_scan._redacted("before " + payload + " after", "<X>") == "before <X> after"
    assert secret_scan.examined("before " + base64.b64encode(zlib.compress(b"A b " * 5000)).decode())[2]
    assert not secret_scan.examined("before " + payload)[2]
