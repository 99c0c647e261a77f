"""DataFrame in, DataFrame out: selection, paging, facets, references, loads, search, suggestions."""
