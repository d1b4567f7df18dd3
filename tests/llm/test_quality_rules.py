import re
from collections import Counter

from voxscope.llm.quality_rules import quality_rules
from voxscope.llm.words import WORD


def base(text):
    words = re.findall(WORD, text or "")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    covered = {j for i, w in enumerate(windows) if seen[w] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(WORD, x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered),
            len(words) < 50 or 100 * len(covered) > 50 * len(words))


def test_counts_by_definition(make, odd_texts):
    texts = [*odd_texts, "a a a a", "x\nx\n x\n\ny # | <b>\nx", "the cat sat the cat sat on the cat sat", "a b " * 40]
    rows = quality_rules(make([(i, t, "en", "s", 0) for i, t in enumerate(texts)])).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "kept_text").collect()
    for r in rows:
        assert tuple(r)[1:7] == base(texts[r.doc_id]), r.doc_id
        assert not (r.base_failed and r.kept)
        assert r.kept_text == (texts[r.doc_id] or "")
    assert len(rows) == len(texts)


def test_frequent_lines_go_and_depleted_documents_are_rejected(make):
    own = [" ".join(f"own{i}x{j}" for j in range(60)) for i in range(300)]
    common = " ".join(f"menu{j}" for j in range(55))
    rows = [(i, t, "en", "a", 0) for i, t in enumerate(own)]
    rows += [(1000 + i, f"{common}\n{t}", "en", "a", 0) for i, t in enumerate(own[:30])]  # frequent, but enough is left
    rows += [(2000 + i, f"  {common.upper()} \nend {i}", "en", "a", 0) for i in range(5)]  # normalised alike, depleted
    rows += [(3000, f"{common}\nend", "en", None, 0), (3001, f"{common}\nend", "en", "b", 0)]  # few documents of their host
    rows += [(4000 + i, f"{own[0]} copy", "en", "a", 0) for i in range(100)]  # exact copies are one document
    out = {r.doc_id: r for r in quality_rules(make(rows)).select("row.doc_id", "kept", "n_frequent_line_words", "kept_text").collect()}
    assert all(out[1000 + i].kept and out[1000 + i].n_frequent_line_words == 55 and out[1000 + i].kept_text == own[i] for i in range(30))
    assert not any(out[2000 + i].kept for i in range(5))
    assert out[3000].kept and out[3001].kept and all(out[4000 + i].kept for i in range(100))


def test_small_hosts_are_judged_like_large_ones(make):
    menu = " ".join(f"menu{j}" for j in range(55))
    for n in (3, 19, 20, 40):
        rows = [(i, f"{menu}\nown{i} a b c d", "en", "h", 0) for i in range(n)] + [(100, " ".join(f"o{j}" for j in range(60)), "en", "h", 0)]
        assert [r.doc_id for r in quality_rules(make(rows)).where("kept").select("row.doc_id").collect()] == [100], n
    pair = [(i, f"{menu}\nown{i} a b c d", "en", "h", 0) for i in range(2)]
    assert quality_rules(make(pair)).where("kept").count() == 2  # two are no repetition yet


def test_clashing_names_and_empty_tables(make):
    rows = make([(1, "a b c", 7, 8, "s")], "doc_id long, text string, c long, n_words long, source string")
    assert [(r.row.c, r.row.n_words, r.n_words) for r in quality_rules(rows).collect()] == [(7, 8, 3)]
    assert quality_rules(make([])).collect() == []
