"""Writers, stage-then-publish and catalog registration."""
