"""Column functions: lenient casts, path lookup, derivations, mart scalars."""
