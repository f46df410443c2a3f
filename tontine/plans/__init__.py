"""Plans: the model-point row path, the seriatim unit-factor path, the query registry."""
