"""Layer-by-layer composition: silver, gold, marts, recommendations."""
