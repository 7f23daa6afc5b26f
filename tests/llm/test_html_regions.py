"""The scan against all contiguous runs, and furniture of any length inside content."""

import random

import pytest

from sessionlab.llm.html_extraction import Weights, best_region, main_text


def brute_region(steps):
    best, at = 0.0, (0, 0)
    where = [k for k, (_, s) in enumerate(steps) if s is not None]
    for a in where:
        for b in where:
            if b >= a and (total := sum(x for x, _ in steps[a:b + 1])) > best + 1e-9:
                best, at = total, (steps[a][1], steps[b][1] + 1)
    return best, at


def test_scan_equals_all_runs():
    draw = random.Random(3)
    for _ in range(400):
        steps, n = [], 0
        for _ in range(draw.randrange(14)):
            if draw.random() < 0.5:
                steps.append((-draw.choice([0.25, 0.5, 1.0]), None))
            else:
                steps.append((draw.choice([-2.0, -0.5, 0.0, 0.5, 1.5, 3.0]), n))
                n += 1
        best, _ = brute_region(steps)
        lo, hi = best_region(steps)
        inside = [k for k, (_, s) in enumerate(steps) if s is not None and lo <= s < hi]
        got = sum(x for x, _ in steps[inside[0]:inside[-1] + 1]) if inside else 0.0
        assert got == pytest.approx(best)
        assert bool(inside) == (best > 0)


def words(tag, n):
    return " ".join(f"{tag}{k}" for k in range(n))


@pytest.mark.parametrize("length", [30, 450, 900, 20_000])
def test_long_asides_inside_content(length):
    first, second, last = words("one", 60), words("two", 60), words("end", 35)
    links = "".join(f"<li><a href=x>{words('rel', 8)}</a></li>" for _ in range(length // 8))
    for head, tail in (("<article>", "</article>"), ("<main>", "</main>"), ('<div class="post-content">', "</div>")):
        for aside in (f"<aside><p>{words('ad', length)}</p></aside>", f'<div class="related"><ul>{links}</ul></div>',
                      f'<section class="comments"><div>{words("said", length)}</div></section>'):
            html = (f"<html><body><nav><a>{words('menu', 20)}</a></nav>{head}<p>{first}</p><p>{second}</p>{aside}<p>{last}</p>{tail}"
                    f"<footer><p>{words('foot', 40)}</p></footer></body></html>")
            assert main_text(html, Weights({})) == f"{first}\n{second}\n{last}"
