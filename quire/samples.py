"""Hand-written blocks that exercise the rules, used alike in queries and SQL."""

BLOCKS = (
    "<p>Plain words without an end</p>", "<p>A finished sentence.</p>", '<p class="footnote">Not plain.</p>', "<p>Two</p><p>paragraphs</p>",
    "<p>harmless to humans.<sup>15–18</sup></p>", "<p>using the software.³²</p>", "<p>charge of Mg²⁺</p>", "<h1>PLOS ONE</h1>", "<h2>RESEARCH ARTICLE</h2>",
    "<h2>Research Article</h2>", "<h1>A Study of Things</h1>", "<h2>1. Introduction</h2>", "<h3>2.1. Plant materials</h3>", "<h4>2.1.3. Growth</h4>", "<h2>(2) Methods here</h2>",
    "<h2>Abstract</h2>", "<h2>Abbreviations</h2>", "<h2>Open Access</h2>", "<h3>Competing interests</h3>", "<h1>References</h1>", "<h2>7. References</h2>",
    "<h2>Literature cited</h2>", "<h2>Table 2</h2>", "<h2>Table setup was used</h2>", "<h2>Results and Discussion</h2>", "<h2 class='x'>No</h2>", "<h2>Wrong</h3>",
    "<p>Fig. 2 shows this</p>", "<p>FIGURE 3. Growth of cells</p>", "<p><strong>Table 1</strong> Values of things</p>", "<p>Table 1</p>", "<p>Table 4 | Kinetic parameters</p>",
    "<p>Table 1 summarizes the results.</p>", "<p>Supplementary Table 2. More</p>", "<p>Scheme 1</p>", "<table><tr><th>A. Liver</th></tr><tr><td>1<sup>a</sup></td></tr></table>",
    "<table><caption>Table 9</caption><tr><td>x</td></tr></table>", "<figure><img src='x'></figure>", "<p>Department of Biology, University of Somewhere, Springfield, USA</p>",
    "<p>Institute of Chemistry, Old Town, Upper Valley</p>", "<p>we asked a department, a college, and others.</p>", "<p>School of Physics, 12 Long Road, Town 12345</p>", "<p>one, two, Germany 69117</p>",
    "<p>Jane A. Doe, John Smith and Al Roe</p>", "<p>Daniel D. Clark</p>", "<p>Jane Doe</p>", "<p>Jane Doe<sup>1</sup>, John Smith*</p>", "<p><em>Ann Lee*</em>, Bo Ray*</p>", "<p>A, b and 3</p>",
    "<p><strong>Keywords:</strong> one; two; three</p>", "<p><strong>Keywords</strong>: one</p>", "<p><strong>Abbreviations:</strong> AB, alpha beta</p>", "<p><strong>Funding:</strong> none was had.</p>",
    "<p><strong>OPEN ACCESS</strong> The abstract begins.</p>", "<p><strong>ABSTRACT</strong>: We did.</p>", "<p><strong>Abstract:</strong> We did.</p>", "<p>Received May 25, 2019</p>",
    "<p>Received 19 June 2018; Revised 23 August 2018; Accepted 2 May 2019</p>", "<p>Published May 25, 2019 in a leading journal, it was read.</p>", "<p>doi: 10.1234/abc.5</p>",
    "<p>Correspondence: a.b@c.org, tel. 123</p>", "<p>Volume 3, Pages 45-67, 2019</p>", "<p>These authors contributed equally to this work.</p>", "<p>*These authors contributed equally</p>",
    "<p>it contributed equally to binding of the rest</p>", "<p><sup>a</sup> Note on a value</p>", "<p><sup>abcd</sup> too long</p>", "<p>¹http://x.org/home</p>", "<p>²H NMR was used</p>",
    "<p>¹ Department of Biology, University, Paris, France</p>", "<p>Data were adapted from Smith</p>", "<p>Source: the registry</p>", "<p>© 2019 The Author(s). Open access under CC BY.</p>",
    "<p>© 2019 The Author(s). All rights reserved.</p>", "<p>Biotechnology and Food 601</p>", "<p>Biotechnology and Food 602</p>", "<p>Clark</p>", "<p>42</p>", "<h3>1234</h3>",
    "<p>ATP: energy, NADH: carrier, all the rest</p>", "<p>this shows that, with the</p>", "<p>we looked at the</p>", "<p>TRII was found</p>", "<p>mTOR was found</p>", "<p>• item</p>", "<p>(a) item</p>",
    "<p>[1] Smith J. A paper.</p>", "<p>12. Smith J. A paper.</p>", "<p>continued in lower case</p>", '<ol start="3">\n<li>\n<p>x</p>\n</li>\n</ol>', "<p>see 10.1000/xyz(12)34). And more</p>",
    "<p>https://doi.org/10.5555/12345678.</p>", "<p>1910.12345/no</p>", "<p>10.1234/a(b(c)).)).,</p>", "<p>x 10.1234/(a.).; y</p>", "![image](image_1.png)10,20,300,400", "![image](image_1.png)", "![alt](x.png)10,20\nFig. 1 Caption", "FIG. 2.", "**Figure 7**", "(A)", "B.",
    "(A) The first panel", "(a) no panel", "## Heading", "| a | b |", "<tr><td>x</td></tr>", "text\n# heading", "†note", "Growth of cells**", "Growth of cells.", "the quick brown fox", "", " ", "Ünïcode Title Here",
    "# 1. Introduction\ntext", "## <b>Abstract</b>", "Table 3. In markdown", "Figure 12: words", "Fig 5 (A) and", "fig 6 shows",
)
