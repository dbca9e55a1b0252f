"""Pairs of texts that collide under any polynomial hash modulo 2**64."""


def thue_morse(a="a", b="b", n=1024):
    """A Thue-Morse sequence of n letters, and its complement."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join((a, b)[x] for x in bits), "".join((b, a)[x] for x in bits)
