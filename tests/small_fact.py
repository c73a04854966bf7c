"""Four entities of one scope that several test modules start from."""

SMALL = [
    ("GUJARAT", "24", "ALPHA", "101", 200, 40, 10),
    ("GUJARAT", "24", "BETA", "102", 100, 15, 5),
    ("GUJARAT", "24", "GAMMA", "103", 160, 30, 10),
    ("GUJARAT", "24", "DELTA", "104", 0, 0, 0),
]
