"""Values shared by the tests."""

# --- Fixed values: the postings fixture, 16 rows (type, id, accepted, parent, score, tag),
# and its languages in index order ------------------------------------------------------
FIXTURE_POSTINGS = [
    (1, 6, None, None, 50, "CSS"),
    (1, 7, None, None, 60, "Java"),
    (1, 8, None, None, 10, "Python"),
    (1, 9, 29, None, 80, "Scala"),
    (1, 10, 20, None, 150, "Java"),
    (1, 40, None, None, 150, "Java"),
    (2, 16, None, None, 50, "CSS"),
    (2, 17, None, 10, 60, "Java"),
    (2, 18, None, None, 10, "Python"),
    (2, 19, None, 9, 80, "Scala"),
    (2, 20, None, 10, 90, "Java"),
    (2, 26, None, 7, 50, "Java"),
    (2, 27, None, None, 60, "Java"),
    (2, 28, None, None, 10, "Python"),
    (2, 29, None, 9, 70, "Scala"),
    (2, 30, None, 9, 150, "Scala"),
]
FIVE_LANGS = ("Python", "Java", "Ruby", "CSS", "Scala")
# ---------------------------------------------------------------------------------------
