"""Column expressions shared by the operators (``text``: line split, bigram and word rules,
last-dot strip, key prefix; ``search``: count of sorted bounds below a key)."""
