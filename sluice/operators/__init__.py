"""DataFrame operators, one module per stage: ``manifest`` (event fold,
claims, registration decisions), ``validate`` (header vs contract),
``bronze`` (scan, gate, publish), ``silver`` (typed, newest per key),
``links`` (reference resolution, coverage), ``quality`` (reports)."""
