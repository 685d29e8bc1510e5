"""Operators: ``f(df, columns, parameters) -> DataFrame``, lazy, JVM-side.

text        line counts, bigrams, bigram counts, words, word counts
ranking     top-k by distinct count with ties, count-descending order
relational  firewall join, per-key counts, group total joined back, group count + arg-max
rangesort   global positions, total-order sort, hash sample, first-char histogram,
            equi-depth boundaries, bucket assignment, bucketed sort, bucket routing
graph       canonical edges, symmetrise, degrees, adjacency, orientation, triangles,
            triangle count, wedge-closure histogram
checksum    byte-range XOR
"""
