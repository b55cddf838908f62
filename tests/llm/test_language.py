from collections import Counter

from rainlane.llm.language import Ranker, gram_codes, identify, learn_profiles

SCHEMA = "id long, text string, lang string, score string, row string"
TEXTS = {
    "en": "the cat and the other things that were there with them when the water was cold",
    "de": "der hund und die anderen sachen waren nicht immer schön aber auch sehr gut dort",
    "fr": "le chat et les autres choses qui étaient avec nous quand il fait très froid là",
}


def grams(text):
    found = Counter()
    for word in text.lower().split():
        letters = "".join(c if c.isalpha() else " " for c in word).split()
        for part in letters:
            padded = f" {part} "
            for n in (1, 2, 3):
                for at in range(len(padded) - n + 1):
                    gram = padded[at : at + n]
                    if gram.strip() and not (n == 1 and gram == " "):
                        found[gram] += 1
    return found


def brute(texts_by_lang, text, size):
    def top(counts):
        return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0].ljust(3, "\0")))][:size]

    profiles = {k: top(sum((grams(t) for t in own), Counter())) for k, own in texts_by_lang.items()}
    mine = top(grams(text))
    far = {
        k: sum(abs(own.index(g) - i) if g in own else size for i, g in enumerate(mine))
        for k, own in profiles.items()
    }
    best = min(sorted(far), key=far.get)
    return best, 1 - far[best] / (size * len(mine))


def test_codes_of_words():
    words = ["It's", "--", "Été", ""]
    codes, counts = gram_codes(words)
    assert counts.tolist() == [sum(grams(w).values()) for w in words]
    assert len(codes) == counts.sum()


def test_against_brute_force(spark):
    rows = [(i, f"{t} {t[: 20 + i]}", k, None, "r") for i, (k, t) in enumerate(TEXTS.items())]
    rows += [(8, None, "en", "s", None), (9, "some words", None, "s", None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    profiles = learn_profiles(docs, size=40)
    learned = {k: [t] for _, t, k, *_ in rows if k and t}
    asked = ["the things", "sehr schön", "une chose très froide", "x", "cat " * 20_000, "the,the!the"]
    for text, (lang, score, n_grams) in zip(asked, Ranker(profiles).predict(asked)):
        want, near = brute(learned, text, 40)
        assert lang == want and abs(score - near) < 1e-9
        assert n_grams == min(40, len(grams(text)))


def test_undetermined_empty_and_unlearned(spark):
    docs = spark.createDataFrame([(i, t, k, "s", "r") for i, (k, t) in enumerate(TEXTS.items())], SCHEMA)
    profiles = learn_profiles(docs)
    odd = spark.createDataFrame([(1, None, None, None, None), (2, "12 34 -- !", "en", "s", "r"), (3, "", "en", "s", "r")], SCHEMA)
    assert [(r.lang_pred, r.score, r.n_grams) for r in identify(odd, profiles).collect()] == [("und", 0.0, 0)] * 3
    assert identify(odd, profiles).columns == ["row", "lang_pred", "score", "n_grams"]
    empty = docs.where("id < 0")
    assert identify(empty, profiles).collect() == []
    assert {r.lang_pred for r in identify(docs, learn_profiles(empty)).collect()} == {"und"}
    assert {(r.row.lang, r.lang_pred) for r in identify(docs, profiles).collect()} == {(k, k) for k in TEXTS}


def test_languages_without_a_letter(spark):
    """A task may hold documents of a language none of which has a letter."""
    rows = [(i, f"{TEXTS['en']} {i}", "en", "s", "r") for i in range(7)]
    rows += [(10 + i, t, "de", "s", "r") for i, t in enumerate(["", "", "12 34", "--", "7", ""])]
    docs = spark.createDataFrame(rows, SCHEMA).coalesce(1)
    profiles = learn_profiles(docs)
    assert profiles.languages == ("en",)
    found = {r.row.id: r.lang_pred for r in identify(docs, profiles).collect()}
    assert {found[i] for i in range(7)} == {"en"} and {found[i] for i in range(10, 16)} == {"und"}


def test_most_languages(spark):
    docs = spark.createDataFrame([(i, t * (i + 1), k, "s", "r") for i, (k, t) in enumerate(TEXTS.items())], SCHEMA)
    assert learn_profiles(docs, most_languages=2).languages == ("de", "fr")
    assert learn_profiles(docs).languages == ("de", "en", "fr")
