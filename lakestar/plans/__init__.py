"""Plans: silver transforms, gold build, marts, registry, assistant, pipeline."""
