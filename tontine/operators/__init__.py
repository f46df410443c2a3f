"""DataFrame operators, one module per layer of the valuation."""
