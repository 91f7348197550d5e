"""Decontamination against benchmarks whose items share sentences, and slices of long texts."""

import random
import time

import pytest

from pricelens.llm import decontaminate as d


def words(rng, n, alphabet="abcdefghijklmnop"):
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(2, 8))) for _ in range(n))


def edited(rng, text, edits):
    x = list(text)
    for _ in range(edits):
        at = rng.randrange(len(x))
        x[at : at + 1] = rng.choice([[], ["q"], ["q", x[at]]])
    return "".join(x)


def one_by_one(items, text):
    """Every item verified against the whole text, without pieces."""
    n, out = f" {d.normalise(text)} ", {}
    for i, t in items:
        core = d.normalise(t)
        if core:
            k, (whole, _) = d.budget(len(core)), d.with_edges(core)
            edits, _ = d.myers(whole, n)
            if edits <= k:
                out[i] = min(edits, out.get(i, edits))
    return out


@pytest.mark.parametrize("share", [0.2, 0.5, 0.9])
def test_items_of_one_template(share):
    """Openings, middles and ends in common; all matches of the edited items are found, and only they."""
    rng = random.Random(share)
    template = words(rng, int(60 * share))
    items = []
    for i in range(60):
        own = words(rng, int(60 * (1 - share)))
        items.append((i, [f"{template} {own}", f"{own} {template}", f"{own[: len(own) // 2]} {template} {own[len(own) // 2 :]}"][i % 3]))
    items += [(100, items[0][1]), (101, items[0][1].upper()), (102, None), (103, "")]
    matcher = d.Matcher(d.prepared(items, d.EDITS_PER_CHAR, d.MIN_PIECE))
    texts = [template, f"{words(rng, 20)} {template} {words(rng, 20)} {template}"]
    for i in range(0, 60, 4):
        text = items[i][1]
        texts += [f"{words(rng, 15)} {edited(rng, text, n)} {words(rng, 15)}" for n in (0, d.budget(len(text)) // 2, d.budget(len(text)), 3 * d.budget(len(text)) + 5)]
    for t in texts:
        assert {h["item_id"]: h["edits"] for h in matcher.find(t)} == one_by_one(items, t)


def test_a_template_alone_verifies_no_item(monkeypatch):
    rng = random.Random(2)
    opening = words(rng, 20)
    items = [(i, f"{opening} {words(rng, 60)}") for i in range(8000)]
    began = time.process_time()
    matcher = d.Matcher(d.prepared(items, d.EDITS_PER_CHAR, d.MIN_PIECE))
    assert time.process_time() - began < 60
    asked = []
    monkeypatch.setattr(d, "myers", lambda *x, f=d.myers: asked.append(1) or f(*x))
    text = f"{words(rng, 15)} {opening} {words(rng, 15)} {opening} {words(rng, 10)} {opening}"
    began = time.process_time()
    assert matcher.find(text) == [] and len(asked) <= 5
    assert time.process_time() - began < 0.1
    held = edited(rng, items[4321][1], 10)
    assert [h["item_id"] for h in matcher.find(f"{text} {held}")] == [4321]


def test_nearly_equal_items_are_all_found():
    rng = random.Random(3)
    base = words(rng, 60)
    items = [(i, edited(rng, base, 2)) for i in range(40)]
    matcher = d.Matcher(d.prepared(items, d.EDITS_PER_CHAR, d.MIN_PIECE))
    assert {h["item_id"]: h["edits"] for h in matcher.find(f"x {base} y")} == one_by_one(items, f"x {base} y")
