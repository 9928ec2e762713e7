def random_words(r, n, letters="abcdefgh"):
    """Invented words of two to seven letters."""
    return ["".join(r.choice(letters) for _ in range(r.randint(2, 7))) for _ in range(n)]
