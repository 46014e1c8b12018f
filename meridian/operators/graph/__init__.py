"""Graph analytics on edge tables.

Canonical undirected edges are ``u, v, weight`` with ``u <= v`` (a self-loop is
one row); the symmetric view ``src, dst, weight`` holds both orientations and a
self-loop once.  Node attributes are ``node, <value>`` tables.
"""
