"""Training-data operators (near duplicates, quality, packing, archives, search).

Nothing else in the library imports this subpackage.
"""
