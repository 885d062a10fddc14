"""Benchmark decontamination beside a plain reading of its rules: all windows of all documents against all windows of all items."""

from __future__ import annotations

import random
from itertools import chain, combinations

from loadweave.llm import decontaminate as d

ITEMS, DOCS = "item_id long, text string", "doc_id long, text string"


def words_of(text):
    """(stretch, kind, what it says, may be a name) of each template word; kinds: plain, number, unit, name."""
    out, opening, after_number = [], True, False
    for s in (text or "").split():
        core = s.strip(d._MARKS)
        said = (core or s).lower()
        kind = None
        if core and (core[0].isdigit() or said in d.NUMBER_WORDS):
            kind = "number"
        elif said in d.UNITS:
            kind = "unit" if after_number else "plain"
        elif core:
            kind = "name" if core[0].isupper() and not core.isupper() else "plain"
        either = kind == "name" and opening
        if kind:
            out.append((s, "plain" if either else kind, said, either))
            opening, after_number = False, kind == "number"
        if s.rstrip("\"')]”’»")[-1:] in (".", "!", "?", ":"):
            opening = True
    return out


def readings(words, start, length):
    """(template, values of its placeholders, which of them open a sentence, plain words, whether words are read as names)."""
    own = words[start : start + length]
    open_at = [k for k, w in enumerate(own) if w[3]]
    for names in chain.from_iterable(combinations(open_at, n) for n in range(len(open_at) + 1)):
        kinds = ["name" if k in names else w[1] for k, w in enumerate(own)]
        slot = [k for k in range(length) if kinds[k] != "plain"]
        template = tuple(("plain", own[k][2]) if kinds[k] == "plain" else (kinds[k],) for k in range(length))
        values = tuple(own[k][0].strip(d._MARKS).lower() or own[k][0] for k in slot)
        yield template, values, tuple(k in names for k in slot), kinds.count("plain"), bool(names)


def literal(text, length):
    said = [(s.strip(d._PUNCTUATION) or s).lower() for s in (text or "").split()]
    return [tuple(said[k : k + length]) for k in range(len(said) - length + 1)]


def item_rows(text):
    """Place, template, values, opens of the item's windows, and their length; templates of literal words have texts in them."""
    words, rows = words_of(text), []
    length = min(d.WINDOW, len(words))
    if not length:
        return [], 0
    for start in range(len(words) - length + 1):
        found = list(readings(words, start, length))
        if found[0][3] >= min(d.LITERALS, length):
            rows += [(start, *r[:3]) for r in found if not r[4] or r[3] >= (d.LITERALS - 1 if length == d.WINDOW else min(d.LITERALS, length))]
    if rows:
        return rows, length
    size = min(d.WINDOW, len(text.split()))
    return ([(k, w, (), ()) for k, w in enumerate(literal(text, size))], -size) if size >= d.LITERALS else ([], 0)


def brute(docs, items):
    texts = {}
    for doc, text in docs:
        texts.setdefault(doc, []).append(text)
    out = {}
    for item, item_text in items:
        rows, length = item_rows(item_text)
        for doc, own in texts.items() if rows else ():
            seen = set()
            for text in own:
                if length < 0:
                    seen |= {(w, ()) for w in literal(text, -length)}
                else:
                    words = words_of(text)
                    seen |= {r[:2] for k in range(len(words) - length + 1) for r in readings(words, k, length)}
            same, values = {}, {}
            for place, template, own_values, opens in rows:
                for found in (v for t, v in seen if t == template):
                    same[place] = same.get(place, False) or found == own_values
                    for mine, theirs, opening in zip(own_values, found, opens, strict=True):
                        values.setdefault(mine, []).append((theirs, opening and theirs == mine))
            told = [len({v for v, _ in x}) == 1 for x in values.values() if not all(idle for _, idle in x)]
            places = len({r[0] for r in rows})
            coverage, steady = len(same) / places, sum(told) / len(told) if told else 1.0
            verbatim = bool(same) and all(same.values())
            if coverage >= d.COVERAGE and (steady >= d.CONSISTENCY or verbatim):
                out[doc, item] = (len(same), places, round(coverage, 9), round(steady, 9), verbatim)
    return out


def made_up(seed):
    rng = random.Random(seed)
    plain = "the a of and has gives finds apples river train house how many old red, left? then it. so: goes (to) – near".split()
    names, numbers, units = "Anna Ben Zoe".split(), "1 2 12 3,5 seven Nine".split(), "km kg % hours days m".split()

    def sentence(n):
        kinds = rng.choices((plain, names, numbers, units), (6, 2, 1, 1), k=n)
        return " ".join(rng.choice(k) for k in kinds)

    items = [(k, sentence(rng.choice([1, 2, 3, 4, 5, 6, 9, 14, 20]))) for k in range(60)]
    items += [(60, "12 7 45 3 9 11"), (61, "Anna Ben Carla"), (62, "7 8"), (63, None), (64, ""), (65, "* - *"), (66, items[8][1]), (67, "Compute 12 * 7 = 84")]
    docs = [(0, None), (1, ""), (None, items[9][1]), (2, " . "), (3, "Compute 12 * 7 = 84 (or 85).")]
    for k in range(10, 160):
        text = rng.choice(items)[1] or "none"
        if rng.random() < 0.7:
            groups = {w: group for group in (names, numbers, units) for w in group}
            swap = {w: rng.choice(group) for w, group in groups.items()}
            torn = rng.random() < 0.3
            text = " ".join((rng.choice(groups[w]) if torn and rng.random() < 0.5 else swap[w]) if w in swap and rng.random() < 0.9 else w for w in text.split())
        docs.append((k, f"{sentence(rng.randrange(4))} {text} {sentence(rng.randrange(4))}"))
    docs += [(170, items[10][1]), (170, items[11][1]), (171, " ".join(t or "" for _, t in items[:40]))]
    return docs, items


def test_contamination_like_brute_force(spark):
    for seed in (1, 2):
        docs, items = made_up(seed)
        found = d.contaminated(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame(items, ITEMS).repartition(3)).collect()
        got = {(r["doc_id"], r["item_id"]): (r["matched"], r["windows"], round(r["coverage"], 9), round(r["consistency"], 9), r["verbatim"]) for r in found}
        want = brute(docs, items)
        assert len(got) == len(found) and got == want
        kinds = {(w[4], w[3] < 1) for w in want.values()}
        assert len(want) > 60 and {(True, False), (False, False), (False, True)} <= kinds
