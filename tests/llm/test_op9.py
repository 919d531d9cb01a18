import base64
import gzip
import hashlib
import random
import re
import urllib.parse
import zlib

from routeweave.llm.op9_secrets import find_secrets, redact_documents, scan, scan_documents

HEXED = "0123456789abcdef0123"


def brute(text):
    """The base patterns as the contract words them."""
    word = "".join(f"[{c}{c.upper()}]" for c in "password")
    keys = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in k)
                    for k in ("password", "passwd", "secret", "token")) + "|[aA][pP][iI]_?[kK][eE][yY]"
    assert word in keys
    out = [(m.start(), 0, m.end()) for m in re.finditer(rf"""({keys})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(out)


def test_base_against_patterns():
    rng = random.Random(3)
    parts = ["token", "TOKEN", "api_key", "apikey", "secret", "ſecret", "toKen", "password", '"', "'", " ", "=", ":", "é",
             "abcdef0123456789", "AKIA", "ABCDEFGH01234567", "x.y-z", "\n", HEXED, "AKIAAKIAAKIAAKIA"]
    for _ in range(3000):
        t = "".join(rng.choice(parts) for _ in range(rng.randrange(1, 14)))
        assert scan(t) == brute(t), t


def test_nested_layers_map_back():
    secret = 'token = "' + HEXED + '"'
    b64 = base64.b64encode(secret.encode()).decode()
    forms = {
        "url": urllib.parse.quote(secret, safe=""),
        "url of all": "".join(f"%{b:02x}" for b in secret.encode()),
        "unicode": "".join(f"\\u{ord(c):04x}" for c in secret),
        "base64": b64,
        "base64 of gzip": base64.b64encode(gzip.compress(secret.encode())).decode(),
        "urlsafe of zlib": base64.urlsafe_b64encode(zlib.compress(secret.encode())).decode().rstrip("="),
        "base64 twice": base64.b64encode(b64.encode()).decode(),
        "url of base64 of gzip of url": urllib.parse.quote(base64.b64encode(gzip.compress(urllib.parse.quote(secret, safe="").encode())).decode(), safe=""),
    }
    for name, f in forms.items():
        text = f"é before {f} after"
        base, every, layers, complete = find_secrets(text)
        a = [s for s in every if s[1] == 0]
        assert a and complete and layers > 1, name
        for start, _, end in every:
            assert 9 <= start < end <= 9 + len(f), (name, start, end)
    # a value encoded alone is found with its plain key
    text = "password: " + "".join(f"%{ord(c):02X}" for c in "hunter2hunter2")
    assert (0, 0, len(text)) in find_secrets(text)[1] and not find_secrets(text)[0]


def test_bounds_and_cycles():
    bomb = base64.b64encode(zlib.compress(b"a " * 500_000)).decode()
    assert find_secrets(bomb, max_layer=10_000)[3] is False
    assert find_secrets("%25" * 50 + "41")[3] is True
    assert find_secrets("100%ed %zz \\uD800 \\x4")[1] == []


def test_common_forms_are_unwrapped_whole():
    import bz2
    import lzma

    import zstandard

    secret = 'some words before it, token = "' + HEXED + '"'
    noise = "".join(chr(97 + i * i * 7 % 26) for i in range(400))
    whole = base64.b64encode((noise + secret + noise).encode()).decode()

    def wrap(t, n, end="\n"):
        return end.join(t[i:i + n] for i in range(0, len(t), n))

    packed = base64.b64encode(zlib.compress(random.Random(1).randbytes(200).hex().upper().encode() + secret.encode())).decode()
    forms = {f"columns {n}": wrap(whole, n) for n in (64, 76)}
    forms |= {"mime": wrap(whole, 76, "\r\n") + "\r\nmore", "indented": wrap(whole, 64, "\n    "), "compressed lines": wrap(packed, 64),
              "pem": f"-----BEGIN CERTIFICATE-----\n{wrap(packed, 64)}\n-----END CERTIFICATE-----"}
    for name, pack in (("gzip", gzip.compress), ("bz2", bz2.compress), ("xz", lzma.compress), ("zlib", zlib.compress),
                       ("zstd", zstandard.ZstdCompressor().compress)):
        forms[name + " members"] = base64.b64encode(pack(b"first member, ") + pack(secret.encode()) + pack(b" third")).decode()
    every = "".join(f"%{b:02x}" for b in secret.encode())
    forms |= {"url with a bad byte": every + "%ff" + "%c3%a9", "unicode with a lone surrogate": "".join(f"\\u{ord(c):04x}" for c in secret) + "\\ud800\\u0041",
              "control character": base64.b64encode(b"\x01" + secret.encode()).decode(),
              "bad byte": base64.b64encode(secret.encode() + b"\xff").decode()}
    for name, f in forms.items():
        text = f"é before {f} after"
        found = [s for s in find_secrets(text)[1] if s[1] == 0]
        assert found and all(9 <= a < b <= 9 + len(f) for a, _, b in found), name


def test_large_blobs_and_texts(docs):
    secret = 'token = "' + HEXED + '"'
    lines = "".join(f"line {i}, some text\n" for i in range(4000))
    bomb = base64.b64encode(zlib.compress((lines + secret + lines).encode())).decode()
    other = base64.b64encode(secret.encode()).decode()
    text = f"<{bomb}> and <{other}>"
    _, every, _, complete = find_secrets(text, max_layer=10_000)
    at = text.index(other)
    assert complete and {(1, 0, 1 + len(bomb)), (at, 0, at + len(other))} <= {s for s in every if s[1] == 0}
    # a value is found with its key beside the blob
    value = base64.b64encode(zlib.compress(("hunter2hunter2 ," + lines).encode())).decode()
    assert (3, 0, 3 + 10 + len(value)) in find_secrets(f"é, password: {value[:0]}"[:3] + "password: " + value, max_layer=10_000)[1]
    # longer than a layer: every part is decoded
    long = (lines + other + ", ") * 3
    spans = find_secrets(long, max_layer=10_000)[1]
    assert sum(s[1] == 0 for s in spans) == 3 and find_secrets(long, max_layer=10_000)[3]
    assert spans == find_secrets(long)[1]
    plain = base64.b64encode(zlib.compress(b"a " * 500_000)).decode()
    flags = {r.doc_id: r.whole for r in redact_documents(docs([(1, plain), (2, "x"), (3, None)]), max_layer=10_000, flag="whole").collect()}
    assert flags == {1: False, 2: True, 3: True}


def test_table(spark, docs):
    rows = [(1, None), (2, ""), (3, "x token=abcdefABCDEF1 y " + HEXED), (3, "x"), (None, "AKIA" + "Z" * 14), (4, "plain " * 5000)]
    got = scan_documents(docs(rows)).collect()
    assert len(got) == len(rows)
    by = {(r.doc_id, r.n_assign): r for r in got}
    r = by[3, 1]
    assert (r.n_access, r.n_hex) == (0, 1) and r.spans == "assign:2:21,hex:24:44"
    assert r.base_sha256 == hashlib.sha256(r.spans.encode()).hexdigest()
    assert by[1, 0].base_sha256 == by[2, 0].base_sha256 == hashlib.sha256(b"").hexdigest()
    red = {(r.doc_id, r.text) for r in redact_documents(docs(rows)).collect()}
    assert (3, "x [secret] y [secret]") in red and (1, None) in red and (None, "[secret]") in red
    assert scan_documents(docs([])).collect() == []
