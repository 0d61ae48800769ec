"""Canonical digests of entire license texts, with the SPDX id of each.

Made by `licenses.digests` from the texts of /usr/share/common-licenses (as they
are wrapped there and with each paragraph on one line; with and without what
follows END OF TERMS AND CONDITIONS), and from copies of the BSD, Unlicense, Zlib
and Boost texts in circulation, whose wording and wrapping vary.
"""

from __future__ import annotations

ENTIRE_TEXTS = (
    "4ce775adc5eb2174f29d3108af3a9370e9699c3247713e6641d0ff8f355e79ac Apache-2.0",
    "6ab5deeb4b2c14f4681b97d03ec0d6cf046968b552bd6e2efe1721910b2e5e9e Apache-2.0",
    "ad487f4222d1dfb8a99d8a7dde283b408d93df794d074b3c92fe9efbe772be32 Apache-2.0",
    "cf7c26411074d941b42afe8baac32788531f003acea32d25ead49048c329c78d Apache-2.0",
    "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702 Artistic-1.0-Perl",
    "cc2cd6cccfacd5fb622fb0e9b9a373fa9dcb86a8c152213a2b856dfbe24fe304 Artistic-1.0-Perl",
    "032f33a9fad178d38ba062bc5f6e47fde5eb48f13d4c8895fe1360e806c83a69 BSD-2-Clause",
    "1a346ec500e0e2a3b0635130743cb752397c1ab0a453dea1a45bea5bc6eaa44a BSD-2-Clause",
    "23d7258e25bd67982ccec4b5bfc05631a20f8ee5bd5fe7eb70694c100aae88d2 BSD-2-Clause",
    "5151319f99abfc15f9a1aab05c799faf3b0e5715fac5a5812b9d3566ae984374 BSD-2-Clause",
    "6091119410d6d441128c7514a97969723030816ec99a6b3939b6c4dfbe349d7e BSD-2-Clause",
    "7be8178e4e9d0dea6ff4b04bd52bd086d7ea8386a5a6e09760df916bae5d42d2 BSD-2-Clause",
    "986c3c3199a93b916c8f2e0aeed57819bcbdcb2cd9d99902dcc9d74b53f93a74 BSD-2-Clause",
    "a56fee4b2f66331ed54da4950ef9c9391453fd1490b4d8ea202bc29683bcbd30 BSD-2-Clause",
    "bb8d5167f37272384441ac2148c59da24c839b381820871d431b344c14921eed BSD-2-Clause",
    "c5cb44b340dfa97436d18371e401686dddf3451388afa1a24c0e410cd7a38b24 BSD-2-Clause",
    "e36c57c376f1fac8945922863988e22c5e7460394aeb78fafeceef531dac4870 BSD-2-Clause",
    "e6240f6a90224648ca9e83c3e91cb58d95b16307f21c35b6262fa28ef93aa186 BSD-2-Clause",
    "0fd69145c89027ee0fdcac45d6c6d27e65a68347e4748d132e4f03e9d6f8bfc3 BSD-3-Clause",
    "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651 BSD-3-Clause",
    "526279aa5ce65fb23ffd45ae5430abc95af7bd6118ff94cc2842185ce6aa2c02 BSD-3-Clause",
    "53075742228962c7ea381b8242c64602fa32e7b8f52facb6d13ee4f9c596ddfa BSD-3-Clause",
    "73d4f18261dc5ce7e97c2c48d40b56085ef20d1ddcb89938580af8b1a99a59fd BSD-3-Clause",
    "928ed7af6f749bfba73610b43518f2269689e5333f42e06ef02577af8e38171b BSD-3-Clause",
    "9704acb0e968f6114297e44ecb944a5ccf8f502ce8a20ff85bb0db70708759ce BSD-3-Clause",
    "9b83d3dee0616d07b82a272dd9bf5134a9f402b750f5ee6188458073b0a32ff2 BSD-3-Clause",
    "a06df82de55c78a283b2dd81105c51f24a3899ddd8e49a08a15b8e55885a36b2 BSD-3-Clause",
    "c165caf2263156afde96f4b02327c2ba96c47bd8cff887df37a4210399885793 BSD-3-Clause",
    "cc65957a28f15bbcef5b0c23770aae3bd8462cb25904250f77a812ab3b2efe15 BSD-3-Clause",
    "cf3a21ae0fa4b9909e6fbcc6dfc6e3bbb5b75c2329ac0d1c9e97283e4a432e7a BSD-3-Clause",
    "d250b3ae78c1eb349a5c3dff4d3046669d8c2382781addd4a55bac5f73fe1227 BSD-3-Clause",
    "f94931e221f919e6cec5ca99e0ea7da1912b2c7d805cdaee8baf508c248bc1af BSD-3-Clause",
    "4242941f56cc0aaf7a416006734167273b17a074704308b941e02a99526671b6 BSL-1.0",
    "cccf7894e1b9f4ba9f97728bf0c5baf9e07bc2ac93da7a51556451b1fb2b868e CC0-1.0",
    "19d29a7c800a0d85704b63b4c09d5cd01dd9a287c61e238f4717d8a9e75d214f GFDL-1.2-only",
    "78f09476d6a64cea1df4919b86fba920c1300c4a6386f8e29e1ffe2b71261d0e GFDL-1.2-only",
    "832d5d32b34e0e82d2380449fc42f833562da417bc1a9c180db0dfb3e93786e2 GFDL-1.3-only",
    "e70f40f3a50995855f972521fe4eaa4af360a4597e5914977b6093cce5243480 GFDL-1.3-only",
    "175f511abd0d3fd5f48cd40e0aaac24652ada233ca289e42f8ffdc9dd5eb8a0e GPL-1.0-only",
    "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc GPL-1.0-only",
    "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224 GPL-1.0-only",
    "9679cb8f8a7c25e849b925136d793d1bec010b8b9270e6ba898e2cefcb3e1f6d GPL-1.0-only",
    "19329ee16e4a9fb2e74ce40708e49f5c315b4f0ac4653c556ca42027ba79f9f5 GPL-2.0-only",
    "b7f81dc9aaaa645304fde476859dc46db4e23b83ec1c50bd8462652ff46110c9 GPL-2.0-only",
    "b866f5427b78991db8012466b32f51c907f5e974fde5129a47372d0d0552e3a1 GPL-2.0-only",
    "e4d14510e41435c3eb12c255b72546a3cb9943f06f209c72bc30a19095b08999 GPL-2.0-only",
    "010ce52b3b970c80b5447205f4afc3b42084811cda2d11b95178b1fd3940764f GPL-3.0-only",
    "3dcf77ad8c25248618918aaff1de8a2cb80cea6ca922ef4a7a389cca96a7560b GPL-3.0-only",
    "7300741b7882c4cee1198306545302285397b5dbcfa263d41588b8b85e01aefd GPL-3.0-only",
    "bd0a51b1879c5ef290541425f811ff5c57e53784e866a9d70a635e8fbcaade54 GPL-3.0-only",
    "052bf540c98a4842bad8d9f2b372e7225b1eb1d38da3916a60bc288db5e37152 LGPL-2.0-only",
    "9b0b3105b96203f9d9e4b72d4b77951152156c88139302b5aedf6295e3ceaaa3 LGPL-2.0-only",
    "e7ecb08f240f58455c2c9090ab912b4bb92385869e21cf6d5eddcdcfc74a1731 LGPL-2.0-only",
    "ff773d8d898dfc51ae2dbf3baa20700673e8ceb153b13d26c525af34a59adf0c LGPL-2.0-only",
    "6d05f602d7a9f9950f9537100bd504a7fdab92cfe89f4f94b0d15721ee014b1f LGPL-2.1-only",
    "963f79d48038eed98d8341c84d8d3b765e99508a738d00654c0112f70a7c370c LGPL-2.1-only",
    "9c8aea52ac2706a35452528904b5cef7c0aa4140e5ec04d54ba60f53c4a5c78b LGPL-2.1-only",
    "cb225061bb71741fe8b31a2092e22fe05b1130438158ae5d16c48fd50186e345 LGPL-2.1-only",
    "11a7eabf884f5575b70a6cff6628e05126a0a629a3b4fb202a995d21f65452b8 LGPL-3.0-only",
    "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be LGPL-3.0-only",
    "286531471d44d2304f376f72d62a3573a9a54a8693a2d7cc3c3ed45fd567e8c5 MPL-1.1",
    "f77c59051c0127d677dcce7ba0d4733294974749a7b4155250912498d92767d6 MPL-1.1",
    "958f21dc8dffc8ff8e2cd52fee0a8a694d6cbc45344ba2aa6e9802e632a8fc03 MPL-2.0",
    "95f6a0d094cf3da6a140310541c7b576789031b600469b70877b34f97918e4c9 MPL-2.0",
    "7a4d92cdb11d254973a073803be1148a5402f1b2ca67808cdb3ef78b596102cd Unlicense",
    "1b8c5cd52eceb19ab0bc3cb40be110b1c0e7fa2671a3fe5866e59dd1502e69c7 Zlib",
    "99618428d879198d4ae824db7ad07a9d0f9214f15429de52839cbe667713f21a Zlib",
)
