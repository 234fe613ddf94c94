import random
import textwrap

from tallyspan.llm import license as lic


def plain_words(text):
    """Words by a loop over characters."""
    out, own = [], ""
    for c in (text or "") + " ":
        if c.isascii() and not c.isalnum():
            if own:
                out.append(own)
            own = ""
        else:
            own += c.lower() if c.isascii() else c
    return out


def window_words(text):
    """Words of a template's blocks: twice a passage, which is the least power of two from twice the template's words on, and 16 at least."""
    passage = 16
    while passage < 2 * len(plain_words(text)):
        passage *= 2
    return 2 * passage


def best_share(own, text):
    """The highest share of a template's different words in one of its half-overlapping windows."""
    want, size = set(plain_words(text)), window_words(text)
    starts = range(0, max(1, len(own) - size // 2), size // 2)
    return max(len(want & set(own[a : a + size])) for a in starts) / len(want)


def test_join_equals_brute_force_and_edges(spark):
    rng = random.Random(8)
    vocab = sorted({w.decode() for s in lic.template_sets().values() for w in s}) + ["zz", "öä", "x1"]
    texts = [None, "", "the MIT license. The mit-license; MIT\nLicense", "general public license", "MIT License " * 3000]
    for _ in range(250):
        lines = []
        for _ in range(rng.randint(1, 4)):
            own = lic.TEMPLATES[rng.choice(list(lic.TEMPLATES))].split()
            own = [w for w in own if rng.random() < rng.choice([1.0, 0.9, 0.75])] + [rng.choice(vocab) for _ in range(rng.randint(0, 30))]
            rng.shuffle(own)
            lines.append(" ".join(own))
        texts.append(("\n" if rng.random() < 0.5 else " ").join(lines) * rng.choice([1, 1, 6]))
    df = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)] + [(None, texts[2], "c")] * 2, "doc_id long, text string, template string")
    rows = lic.licenses(df).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        text = texts[r.doc_id] if r.doc_id is not None else texts[2]
        own = plain_words(text)
        best = {name: x for name, t in lic.TEMPLATES.items() if (x := best_share(own, t)) >= 0.8 - 1e-9}
        assert r.found == sorted(best)
        assert abs(r.containment - max(best.values(), default=0)) < 1e-12
        plain = own
        places = [(i, label) for p, label in lic.PHRASES.items() for i in range(len(plain)) if plain[i : i + len(p.split())] == p.split()]
        assert (r.n_words, r.n_base) == (len(plain), len(places))
        assert (r.first_word, r.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert list(r.base) == sorted({x for _, x in places})
    assert lic.licenses(df.limit(0)).count() == 0


def test_wrapped_grants_equal_brute_force_over_all_windows(spark):
    rng = random.Random(5)
    grants = [k for k in lic.TEMPLATES if k.endswith("grant")]
    filler = lambda n: " ".join(rng.choice(["foo", "bar", "qux", "the", "of"]) for _ in range(n))
    texts = {}
    for i in range(80):
        name = rng.choice(list(lic.TEMPLATES))
        body = f"{filler(rng.randint(0, 400))} {lic.TEMPLATES[name]} {filler(rng.randint(0, 400))}"
        texts[i] = (name, "".join(f"{rng.choice(['', ' * ', '# ', 'REM '])}{line}\n" for line in textwrap.wrap(body, rng.randint(30, 80))))
    texts[80] = ("mit-notice", "Released under\nthe MIT License")
    for name in grants:
        texts[name] = (name, "\n\n".join(lic.TEMPLATES[name].split()))  # a word a line
    rows = lic.licenses(spark.createDataFrame([(str(i), t) for i, (_, t) in texts.items()], "doc_id string, text string")).collect()
    assert len(rows) == len(texts)
    by = {str(i): x for i, x in texts.items()}

    def held(own, part):
        """Templates of which some run of ``part`` of their window's words holds enough."""
        out = set()
        for n, t in lic.TEMPLATES.items():
            want, size = set(plain_words(t)), window_words(t) // part
            if any(len(want.intersection(own[a : a + size])) >= 0.8 * len(want) - 1e-9 for a in range(len(own))):
                out.add(n)
        return out

    for r in rows:
        name, text = by[r.doc_id]
        own = plain_words(text)
        assert name in r.found
        assert held(own, 2) <= set(r.found) <= held(own, 1)


def test_windows_follow_the_longest_template(spark):
    long = " ".join(f"w{i}" for i in range(300))
    df = spark.createDataFrame([(at, "x " * at + long.replace(" ", "\n")) for at in range(0, 700, 50)], "doc_id long, text string")
    assert all(r.found == ["long"] and r.containment == 1 for r in lic.licenses(df, templates={"long": long}).collect())
