"""Jobs made of the operators."""
