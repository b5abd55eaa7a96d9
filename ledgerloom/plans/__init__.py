"""Named reports and jobs composed of the operators."""
