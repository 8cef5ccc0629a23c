"""License scan against edit distances of all word ranges."""

import random
import re

from tidewatch.llm import licenses

BASE = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}


def words_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        diag, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diag, row[j] = row[j], min(diag + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def least(n, words):
    """Least number of edits of a notice over all ranges of words, or None."""
    best = None
    for i in range(len(words)):
        for j in range(i + 1, min(len(words), i + len(n.text) + n.k) + 1):
            s = " ".join(words[i:j])
            if len(s) > len(n.text) + n.k:
                break
            if s.startswith(n.before) and s.endswith(n.after) and len(s) >= len(n.before) + len(n.after):
                middle = s[len(n.before):len(s) - len(n.after)]
                if abs(len(middle) - len(n.phrase)) > n.k:
                    continue
                d = distance(middle, n.phrase)
                best = d if d <= n.k and (best is None or d < best) else best
    return best


def base_places(words):
    return sorted((i, label) for label, p in BASE.items() for i in range(len(words)) if words[i:i + len(p.split())] == p.split())


def bent(rng, text, edits):
    for _ in range(edits):
        i = rng.randrange(len(text))
        text = rng.choice([text[:i] + text[i + 1:], text[:i] + rng.choice("eé sx.") + text[i:], text[:i] + rng.choice("aß L") + text[i + 1:]])
    return text


def texts():
    rng = random.Random(3)
    out = [None, "", " .,\n", "commit license, MIT licensed, mit linse, MITLicense", "MIT License MIT License", "The Apache\nLicence; GNU Lesser General Public License", "é mit license mit license", "mit license " * 300]
    for _ in range(80):
        parts = [rng.choice(["und so", "license", "permission is", "x"])]
        for _ in range(rng.randrange(1, 4)):
            n = rng.choice(licenses.NOTICES)
            parts += [bent(rng, n.text, rng.randrange(0, n.k + 2)), rng.choice(["zum Beispiel", "general", "mit", "the", "."])]
        out.append(rng.choice([" ", "\n", ", "]).join(parts))
    return out


def test_against_all_ranges(spark):
    rows = list(enumerate(texts()))
    got = {r.doc_id: r for r in licenses.notices_in(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()}
    assert len(got) == len(rows)
    for k, text in rows:
        words, r = words_of(text), got[k]
        assert r.n_words == len(words)
        assert sorted((m.first_word, m.label) for m in r.matches if m.base) == base_places(words)
        short = words if len(words) < 100 else words[:10]
        for n in licenses.NOTICES:
            found = [m.errors for m in r.matches if m.notice == n.text]
            assert (min(found) if found else None) == least(n, short), (text, n)
        for m in r.matches:
            assert words_of(text[m.start:m.end]) == words[m.first_word:m.first_word + m.n_words]


def test_query_columns(spark, odd_documents, no_documents, monkeypatch):
    mit = odd_documents.selectExpr("doc_id", "CASE WHEN doc_id = 9 THEN 'x (MIT Licence) x mit license the apache license' ELSE text END AS text", "uid", "'z' AS matches")
    monkeypatch.setattr(licenses, "table", lambda *a: mit)
    got = licenses.op12_license_scan(spark, "").collect()
    assert len(got) == odd_documents.count() and sum(r.n_base for r in got) == 2
    r = next(r for r in got if r.doc_id == 9)
    assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score, r.n_places) == (9, 2, 4, 7, "apache,mit", "apache,mit", 1.0, 3)
    r = next(r for r in got if r.doc_id == 3)
    assert (r.n_words, r.n_base, r.first_word, r.base_labels, r.labels, r.score) == (0, 0, None, "", "", 0.0)
    monkeypatch.setattr(licenses, "table", lambda *a: no_documents)
    assert licenses.op12_license_scan(spark, "").count() == 0


def test_time_is_linear():
    import time

    finder = licenses.Finder(licenses.NOTICES)
    t0 = time.time()
    for text in ("license " * 100_000, "x" * 2_000_000, "mit licence " * 50_000, "apache apache general public " * 30_000):
        licenses.scan(finder, text)
    assert time.time() - t0 < 30
