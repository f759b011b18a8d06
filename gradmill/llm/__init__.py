"""Operations of a training-data pipeline over document, page and vector tables.

Nothing outside this package imports it. Each module holds one operator with a
general interface; ``queries`` derives the registered ``opN_…`` results from them.
"""
