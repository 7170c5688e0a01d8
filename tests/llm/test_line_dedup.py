from collections import defaultdict

import pytest

from rivulet.llm import line_dedup as L
from tests.llm.cases import awkward, awkward_rows, prose

BLANK = " \t\x0b\x0c\r"


def brute(rows, least):
    sites = defaultdict(set)
    for _, text, _, source, _ in rows:
        for line in (text or "").split("\n"):
            if line.strip(BLANK):
                sites[line.strip(BLANK)].add(source)
    shared = {x for x, s in sites.items() if len(s) >= least}
    out = []
    for doc_id, text, *_ in rows:
        lines = [] if text is None else text.split("\n")
        kept = [x for x in lines if x.strip(BLANK) not in shared]
        stripped = None if text is None else "\n".join(kept)
        out.append((doc_id, len(lines), len(lines) - len(kept), stripped))
    return sorted(out, key=str)


def rows():
    out = awkward_rows()
    for k in range(40):
        bar = f"Home | About\n  cookie notice {k % 2} \n{prose(k, 20)}\n\n{prose(100 + k, 9)}\r\nfooter\nfooter"
        out.append((200 + k, bar, "en", f"site{k % 13}" if k else None, 1))
    out.append((300, "footer\nHome | About\nown", "en", "s1", 1))
    return out


@pytest.mark.parametrize("least", [2, 5, 13, 14])
def test_equals_brute_force(spark, least):
    docs = awkward(spark, rows()).withColumnRenamed("kept", "n_removed")
    found = L.drop_shared_lines(docs, "source", least)
    assert sorted(((r.doc_id, r.n_lines, r.n_removed, r.text) for r in found.collect()), key=str) == brute(rows(), least)
    assert found.columns == [c for c in docs.columns if c != "n_removed"] + ["n_lines", "n_removed"]


def test_empty(spark):
    assert L.drop_shared_lines(awkward(spark, [])).count() == 0


def by_text_rows():
    """Pages that are mostly menu, and one text that twelve sites copy."""
    menu = "\n".join(prose(500 + j, 12) for j in range(6))
    pages = [(k, f"{menu}\n{prose(k, 20)}", "en", f"site{k}" if k else None, 1) for k in range(12)]
    copies = [(50 + k, prose(600, 30) + "\n" + prose(601, 30), "en", f"site{k}", 1) for k in range(12)]
    return [*pages, *copies, (90, menu, "en", "site1", 1), (91, None, "en", "site1", 1), (92, "", "en", "site1", 1)]


@pytest.mark.parametrize("least", [2, 6, 12, 13, 14])
def test_by_text_every_shared_line_goes_and_copies_stay(spark, least):
    sites, texts = defaultdict(set), defaultdict(set)
    for _, text, _, source, _ in by_text_rows():
        for line in (text or "").split("\n"):
            sites[line].add(source)
            texts[line].add(text)
    want = []
    for doc_id, text, *_ in by_text_rows():
        lines = [] if text is None else text.split("\n")
        kept = [x for x in lines if not x or len(sites[x]) < least or len(texts[x]) < least]
        want.append((doc_id, len(lines), len(lines) - len(kept), None if text is None else "\n".join(kept)))
    docs = awkward(spark, by_text_rows())
    found = L.drop_shared_lines(docs, "source", least, by_text=True).collect()
    assert sorted((r.doc_id, r.n_lines, r.n_removed, r.text) for r in found) == want
    if least <= 12:
        assert want[0][2] == 6 and 2 * len(want[0][3]) < len(by_text_rows()[0][1])
        assert want[12][2] == 0


def test_pipeline_strips_pages_that_are_mostly_menu(spark):
    import corpus_pipeline as P

    docs = awkward(spark, by_text_rows()).select("doc_id", "text", "lang", "source", "n_chars")
    text = {r.doc_id: r.text for r in P.line_dedup(spark, docs, "").collect()}
    assert [text[k] for k in range(12)] == [prose(k, 20) for k in range(12)]
    assert text[50] == text[61] == prose(600, 30) + "\n" + prose(601, 30)


def test_near_copies_leave_one_whole_article(spark):
    """Ten near copies on ten sites count as one text; a footer of unlike pages still goes."""
    import corpus_pipeline as P
    from rivulet.llm.near_dedup import keep_one, text_groups

    body = [prose(500 + k, 12) for k in range(40)]
    rows = []
    for k in range(10):
        text = "\n".join([*body[:k], prose(700 + k, 12), *body[k + 1 :]])
        rows.append((k, text, "en", f"s{k}", len(text)))
        rows.append((100 + k, prose(800 + k, 60) + "\nthe footer of every page", "en", f"s{k}", 1))
    docs = awkward(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    texts = {r.doc_id: r.text for r in docs.collect()}
    # by texts alone the copies lose what they share
    plain = L.drop_shared_lines(docs, "source", 9, by_text=True).where("doc_id < 100")
    assert all(r.n_removed >= 10 for r in plain.collect())
    groups = text_groups(docs)
    assert groups.count() == 9 and groups.select("group_key").distinct().count() == 1
    found = {r.doc_id: r for r in L.drop_shared_lines(docs, "source", 9, True, groups).collect()}
    assert all(found[k].text == texts[k] and found[k].n_removed == 0 for k in range(10))
    assert all(found[100 + k].text == texts[100 + k].split("\n")[0] for k in range(10))
    done = P.line_dedup(spark, docs, "")
    kept = {r.doc_id: r.text for r in keep_one(done).collect()}
    assert len(kept) == 11 and sum(kept[d] == texts[d] for d in kept if d < 100) == 1
