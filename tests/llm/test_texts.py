import hashlib
import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import Row

from tidemark.llm import fingerprints, licenses, pii

SCHEMA = "doc_id long, text string, part string, copy string, n_entities int, fingerprint string"


def frame(spark, rows):
    return spark.createDataFrame([Row(i, t, "clash", "clash", 9, "clash") for i, t in rows], SCHEMA)


# Fingerprints ----------------------------------------------------------------

def jaccard(a, b):
    a, b = set(fingerprints.digests(a).tolist()), set(fingerprints.digests(b).tolist())
    return len(a & b) / len(a | b) if a | b else 1.0


def text(rng, lines):
    return "\n".join(" ".join(rng.choices(["ab", "cd", "ef", "gh", "ij"], k=6)) for _ in range(lines))


def test_peeling_recovers_the_jaccard_index():
    rng = random.Random(0)
    a = [text(rng, n) for n in (0, 1, 5, 40, 400, 3, 900)]
    b = [a[0], text(rng, 3), a[2] + "\nnew one", a[3][:len(a[3]) // 2], text(rng, 380), a[5], a[6] + "\n" + text(rng, 9)]
    got = fingerprints.likeness([fingerprints.digests(x) for x in a], [fingerprints.digests(x) for x in b])
    assert np.allclose(got, [jaccard(x, y) for x, y in zip(a, b, strict=True)])


def test_repeated_paragraphs_count():
    one, two = fingerprints.digests("same\nsame\nsame"), fingerprints.digests("same\nsame")
    assert len(set(one.tolist())) == 3 and set(two.tolist()) < set(one.tolist())


def test_digests_of_short_repeated_paragraphs_are_distinct():
    t = "\n".join(["a", "b", "ab", "!"] * 3000)
    assert len(fingerprints.digests(t)) == 12_000
    one, two = fingerprints.digests(t), fingerprints.digests(t + "\nab\nzz")
    assert fingerprints.likeness([one], [two])[0] == 12_000 / 12_002


def test_failed_sketches_are_built_larger():
    small = fingerprints.Sketches.of([fingerprints.digests(text(random.Random(1), 200))], fingerprints.CELLS)
    assert not small.minus(fingerprints.Sketches(1, fingerprints.CELLS)).peel()[2][0]


@pytest.mark.parametrize("ranges", [1, 3, 8])
def test_edits_by_brute_force(spark, ranges):
    rng = random.Random(2)
    rows = [(i * 3, text(rng, rng.randrange(0, 8))) for i in range(40)]
    rows += [(None, "no id\nat all"), (7, None), (8, ""), (200, "é🙂" * 50), (201, "x" * 30_000)]
    got = {r.doc_id: r for r in fingerprints.fingerprint_edits(frame(spark, rows).repartition(4), ranges).collect()}
    assert len(got) == len(rows)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    for (i, t), (_, n) in zip(order, order[1:] + order[:1], strict=True):
        t, n = t or "", n or ""
        k = len(t) // 3
        changed = t[:len(t) - k] + n[:k]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert r.near_edited == pytest.approx(jaccard(t, changed)) and r.near_next == pytest.approx(jaccard(t, n))
        if t == changed:
            assert r.fingerprint == r.edited_fingerprint


def test_fingerprints_of_few_and_repeated_rows(spark):
    assert fingerprints.fingerprint_edits(frame(spark, [])).count() == 0
    one = fingerprints.fingerprint_edits(frame(spark, [(5, "a b\nc")]), 4).collect()
    assert [r.near_next for r in one] == [1.0]
    same = fingerprints.fingerprint_edits(frame(spark, [(5, "a b\nc")] * 6), 4).collect()
    assert len(same) == 6 and {r.near_next for r in same} == {1.0} and len({r.fingerprint for r in same}) == 1


# Personal data ---------------------------------------------------------------

CASES = {
    "email": "anna.72@mail3.example.com",
    "ip": "152.143.123.131",
    "phone": "+1 (017) 555-7713",
    "card": "4111 1111 1111 1111",
    "ssn": "123-45-6789",
    "iban": "DE89 3704 0044 0532 0130 00",
    "secret": "24be64439e3e49cf46b2d7c90f3602a3d0b907ff",
}


@pytest.mark.parametrize("kind", CASES)
def test_surrogates_keep_kind_and_format(kind):
    value = CASES[kind]
    found = pii.detect(f"so {value}, end")
    assert [(k, v) for _, _, k, v in found] == [(kind, value)]
    new, n = pii.replace(f"so {value}, end", lambda e: 0)
    assert n == 1 and value not in new and new.startswith("so ") and new.endswith(", end")
    got = new[3:-5]
    assert [k for _, _, k, _ in pii.detect(new)] == [kind]
    if kind != "ip":
        assert re.sub(r"[A-Z]", "A", re.sub(r"[a-z]", "a", re.sub(r"\d", "0", got))) == \
            re.sub(r"[A-Z]", "A", re.sub(r"[a-z]", "a", re.sub(r"\d", "0", value))) or kind == "secret"
    if kind == "card":
        assert pii.luhn(re.sub(r"\D", "", got))
    assert pii.replace(f"so {value}, end", lambda e: 0, b"other key")[0] != new
    assert pii.replace(f"so {value}, end", lambda e: 1)[0] != new


def test_mentions_of_one_entity_agree():
    a = pii.replace("a@bc.org 4111111111111111 then A@BC.ORG 4111 1111 1111 1111 4111-1111-1111-1111", lambda e: 0)[0]
    mail, card, _, mail2, *rest = a.split(" ")
    assert mail.upper() == mail2
    assert card == "".join(rest[:4]) == rest[4].replace("-", "")


def test_names_keep_gender_script_and_coreference():
    new, n = pii.replace("Mr. John Smith met Mrs Anna Jones. Smith left; John too. Господин Иван Петров", lambda e: 0)
    assert n == 8 and not re.search("Smith|John|Anna|Jones|Иван|Петров", new)
    m = re.fullmatch(r"Mr\. (\w+) (\w+) met Mrs (\w+) (\w+)\. (\w+) left; (\w+) too\. Господин (\w+) (\w+)", new)
    assert m.group(2) == m.group(5) and m.group(1) == m.group(6)
    assert m.group(3).endswith("a") and not m.group(1).endswith("a")
    assert all("CYRILLIC" == pii._script(c) for c in m.group(7) + m.group(8))


def test_clean_texts_stay(spark):
    for t in (None, "", "no data 12 or 3.5, 2024-01-01 and v1.2.3", "x" * 20_000, "May the of William"):
        assert pii.replace(t, lambda e: 0) == (t, 0)


@pytest.mark.parametrize("max_broadcast", [1000, 0])
def test_entities_stay_distinct(spark, max_broadcast):
    # A tiny space of surrogates: twelve entities in twenty, and three of the real values among them.
    values = [f"u{i}@x.org" for i in range(12)]
    rows = [(i, f"mail {values[i % 12]} and {values[(i + 5) % 12]}") for i in range(40)] + [(None, None), (99, "")]
    d = frame(spark, rows)

    def tiny(kind, value, attempt=0, key=b""):
        return f"u{(sum(value.encode()) * 7 + attempt) % 20 + 9}@x.org"

    moved = pii.later_attempts(d, make=tiny)
    later = {(r.kind, r.value): r.attempt for r in moved.collect()}
    new = {v: tiny("email", v, later.get(("email", v), 0)) for v in values}
    assert len(set(new.values())) == 12 and not set(new.values()) & set(values) and later
    out = pii.with_surrogates(d, max_broadcast=max_broadcast, make=tiny)
    assert out.columns == [c for c in d.columns if c != "n_entities"] + ["n_entities"]
    got = {r.doc_id: r for r in out.collect()}
    for i, t in rows:
        want = re.sub(r"u\d+@x\.org", lambda m: new[m.group()], t) if t else t
        assert got[i].text == want and got[i].n_entities == (2 if t else 0)


LEADS = ['password = "correcthorsebattery"', 'api_key = "lettersonly"', "Token: lettersonly", 'secret = "lettersonly"',
         'token = "lettersonly"', "AKIA" + "ABCDEFGH" * 2, "ghp_" + "abcdef" * 6, "sk-" + "lettersonly" * 2, "abcdef" * 6,
         "ab:cd:ef:ab:cd:ef:ab:cd", "fe::ab:cd"]


@pytest.mark.parametrize("t", LEADS)
def test_letters_alone_are_found(monkeypatch, t):
    got = pii.detect(f"so {t} end")
    monkeypatch.setattr(pii, "_MAYBE", re.compile(""))
    assert got and got == pii.detect(f"so {t} end")


@pytest.mark.parametrize(("t", "want"), [
    ("host 2001:db8::1, up", ["2001:db8::1"]), ("on ::1 and fe80::1ff:fe23:4567:890a.", ["::1", "fe80::1ff:fe23:4567:890a"]),
    ("2001:db8:0:0:0:0:2:1", ["2001:db8:0:0:0:0:2:1"]), ("net 2001:db8:: is", ["2001:db8::"]),
    ("std::cout a::b Foo::Bar :: 1::2::3", []), ("::ffff:192.0.2.1", ["192.0.2.1"])])
def test_abbreviated_addresses(t, want):
    found = pii.detect(t)
    assert [v for _, _, _, v in found] == want and {k for _, _, k, _ in found} <= {"ip"}
    assert pii.replace(t, lambda e: 0)[1] == len(want)
    assert len({pii.surrogate("ip", "::1", a) for a in range(40)}) > 16


@pytest.mark.parametrize(("kind", "value", "space"), [
    ("email", "a@b.com", 676), ("secret", "********", 1), ("ip", "192.168.1.1", 65_536)])
def test_spaces_of_surrogates_widen(kind, value, space):
    new = {pii.surrogate(kind, value, a) for a in range(space + 10 if space < 1000 else 10)}
    assert len(new) > space or (kind == "ip" and any(not x.startswith("192.168.") for x in new))


def test_names_and_numbers_widen():
    assert len(pii.surrogate("surname", "smith", 40)) > len(pii.surrogate("surname", "smith", 0)) + 20
    assert len(pii.surrogate("phone", "1234567", 9)) > 7 and len(pii.surrogate("ssn", "123456789", 9)) > 9
    assert pii.shaped("12-34", "56789", "phone") == "56-789"


def test_more_entities_than_the_first_space(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    values = [f"{a}@{b}.com" for a in letters for b in letters]
    d = frame(spark, [(i, f'write {v} token: ********') for i, v in enumerate(values)])
    later = {r.value: r.attempt for r in pii.later_attempts(d).collect()}
    new = {pii.surrogate("email", v, later.get(v, 0)) for v in values}
    assert len(new) == 676 and not new & set(values) and later["********"] >= pii.WIDER_FROM


def test_personal_data_in_no_rows(spark):
    assert pii.with_surrogates(frame(spark, [])).count() == 0


# Licences ----------------------------------------------------------------------

MIT = "\n\n".join(licenses.TEXTS["MIT"][:1]) + ":\n\n" + ".\n\n".join(licenses.TEXTS["MIT"][1:]) + "."


def wrapped(t, width=60):
    out, line = [], ""
    for w in t.split(" "):
        if len(line) + len(w) > width:
            out.append(line)
            line = w
        else:
            line = f"{line} {w}".strip()
    return "\n".join([*out, line])


@pytest.mark.parametrize(("t", "want"), [
    ("x y.\nLicensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0/notice"]),
    ("a***\nThis work is licensed under the GNU General Public License, version 3.", ["GPL-3.0/notice"]),
    ("Released under the MIT License. Licensed under the Apache License, Version 2.0.",
     ["MIT/notice", "Apache-2.0/notice"]),
    ("LICENSED!! UNDER!! CC!! BY-NC!! 4.0.!!", ["CC-BY-NC-4.0/notice"]),
    ("// SPDX-License-Identifier: BSD-3-Clause", ["BSD-3-Clause/notice"]),
    ("SPDX-License-Identifier: Apache-2.0", ["Apache-2.0/notice"]),
    (MIT, ["MIT/text"]), (wrapped(MIT), ["MIT/text"]),
    (". ".join(reversed(licenses.TEXTS["MIT"])), []),
    (".\n".join([*licenses.TEXTS["BSD-2-Clause"], licenses.BSD_ENDORSE]), ["BSD-3-Clause/text"]),
    (".\n".join(licenses.TEXTS["BSD-2-Clause"]), ["BSD-2-Clause/text"]),
    ("driver's license under review, all rights reserved", []), (None, []), ("", []),
])
def test_licences(t, want):
    assert [m[0] for m in licenses.match(licenses.recognise(t))] == want


GPL = """    {what} is free software{a} you can redistribute it and/or modify
    it under the terms of the GNU {kind}General Public License as published by
    the Free Software Foundation{b} either version {version} of the License, or
    (at your option) any later version.

    {what} is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.
"""


@pytest.mark.parametrize(("t", "want"), [
    ("""MIT License

Copyright (c) 2020 A. Author

""" + wrapped(MIT.replace("\n\n", " ", 1)).replace("Software. The", "Software.\n\nThe"), ["MIT/text"]),
    ("ISC License\n\nCopyright (c) 2020, A Author\n\n" + wrapped(licenses.TEXTS["ISC"][0]) + ".\n", ["ISC/text"]),
    ("Copyright (c) 2020, A\nAll rights reserved.\n \n" + wrapped(licenses.TEXTS["BSD-2-Clause"][0]) + ":\n\n1. "
     + wrapped(licenses.TEXTS["BSD-2-Clause"][1]) + ".\n\n2. " + wrapped(licenses.TEXTS["BSD-2-Clause"][2]) + ".\n",
     ["BSD-2-Clause/text"]),
    ("a program\nCopyright (C) 2020  A\n\n" + GPL.format(what="This program", a=":", b=",", kind="", version=3),
     ["GPL-3.0/text"]),
    ("a program\n\n" + GPL.format(what="This program", a=";", b=";", kind="", version=2), ["GPL-2.0/text"]),
    ("a library\n\n" + GPL.format(what="This library", a=";", b=";", kind="Lesser ", version=3), ["LGPL-3.0/text"]),
    ("a program\n\n" + GPL.format(what="This program", a=":", b=",", kind="Affero ", version=3), ["AGPL-3.0/text"]),
    ("/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL "
     "was not distributed with this\n * file, You can obtain one at https://mozilla.org/MPL/2.0/. */", ["MPL-2.0/text"]),
])
def test_whole_licence_files(t, want):
    assert [m[0] for m in licenses.match(licenses.recognise(t))] == want


def test_every_known_sentence_can_be_found():
    for s, identifier in licenses.sentences().items():
        assert licenses._TRIGGER.search(s), s
        assert [f[2] for f in licenses.recognise(s)] == [identifier]


def test_scan(spark):
    rows = [(1, "x\nReleased under the MIT License."), (1, "x\nReleased under the MIT License."), (2, None), (3, ""),
            (None, "Licensed under CC BY 4.0."), (4, "y " * 30_000)]
    out = licenses.scan(frame(spark, rows)).collect()
    assert sorted((str(r.doc_id), r.licence, r.start, r.end) for r in out) == [
        ("1", "MIT", 2, 33), ("1", "MIT", 2, 33), ("None", "CC-BY-4.0", 0, 25)]
    assert licenses.scan(frame(spark, [])).count() == 0


def test_nested_units_by_brute_force():
    rng = random.Random(6)
    for _ in range(300):
        found = set()
        for _ in range(rng.randrange(25)):
            a = rng.randrange(20)
            found.add((a, a + rng.randrange(1, 12), rng.choice("xyz")))
        want = {f for f in found if not any(g != f and g[2] == f[2] and f[0] <= g[0] and g[1] <= f[1] for g in found)}
        assert set(licenses.tightest(found)) == want and len(licenses.tightest(found)) == len(want)


def test_rules_by_brute_force():
    """Every stretch of a sequence of sentences tried against every rule: the longest rule that fits goes first."""
    rng = random.Random(8)
    ids = sorted({i for _, _, wanted in licenses.rules() for i in wanted})
    texts = [w for _, _, w in licenses.rules() if len(w) > 1]
    for _ in range(200):
        seq = []
        while len(seq) < 12:
            w = list(rng.choice(texts)) if rng.random() < 0.5 else [rng.choice(ids)]
            seq += w[:rng.randrange(1, len(w) + 1)] if rng.random() < 0.3 else w
        found = [(10 * i, 10 * i + 9, x) for i, x in enumerate(seq)]
        want, i = [], 0
        while i < len(seq):
            fits = [(len(w), n, lic) for n, lic, w in licenses.rules() if tuple(seq[i:i + len(w)]) == w]
            if not fits:
                i += 1
                continue
            size = max(f[0] for f in fits)
            _, name, lic = min((f for f in fits if f[0] == size), key=lambda f: f[1])
            want.append((name, lic, found[i][0], found[i + size - 1][1], size))
            i += size
        assert licenses.match(found) == want


def test_many_notices_take_time_in_proportion():
    import time
    line = "This program is licensed under the MIT license.\n"
    t0 = time.time()
    few = len(licenses.recognise(line * 500))
    t1 = time.time()
    many = len(licenses.recognise(line * 4000))
    assert (few, many) == (500, 4000) and time.time() - t1 < 30 * max(t1 - t0, 0.01)


def test_pii_texts_without_entities_are_told_apart_fast():
    texts = ["plain words only", "Mr. Brown", "aMr Brown", "Mrx Brown", "Мария Господин Иванов", "Jürgen", "jürgen",
             "x::y", "a:b:c:d:e:f:a:b", "a:bcde:", "TOKEN: abcdefgh", "toKen: abcdefgh", "ſecret = \"abcdefgh\"",
             "APİ_KEY = \"abcdefgh\"", "ſk-" + "x" * 20, "AKİA" + "B" * 16, "akıa" + "B" * 16,
             "GHP_" + "z" * 36, *["x" * i + " " + "abcdefAB" * 4 for i in range(4)], "a" * 31, "me@here.example", "5", "٣"]
    signs = [k for k, p in pii.PATTERNS for _ in p.finditer(" ".join(texts))]
    assert {"secret", "ip", "email"} <= set(signs)
    for t in texts:
        holds = any(p.search(t) for _, p in pii.PATTERNS) or pii._NAMED.search(t)
        assert pii._MAYBE.search(t) or not holds, t
    assert not pii._MAYBE.search("plain words only") and not pii._MAYBE.search("aMr Brown")
    # One pass over a text is a scan: no position costs a try of every name.
    long = "the words of a long text without anybody in it and so on " * 2_000
    every = re.compile(rf"(?<!\w)(?:{pii._TITLED}|{pii._GIVEN})(?!\w)")
    times = []
    for scan in (pii.detect, every.search):
        start = time.process_time()
        for _ in range(5):
            assert not scan(long)
        times.append(time.process_time() - start)
    assert times[0] < times[1] / 2
