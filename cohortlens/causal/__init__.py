"""Edge lists, linear structural models, counterfactual rows."""
